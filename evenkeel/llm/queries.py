"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm import (
    conversation_repair,
    embedding_dedup,
    mixing,
    neighbors,
    packing,
    prefix_trie,
    quality,
    sharding,
    simhash,
    token_files,
    toxicity,
    urls,
    warc,
)
from evenkeel.llm.common import table
from evenkeel.llm.oracles import ORACLES
from evenkeel.staging import scratch_path

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_pages(table(spark, sf_dir, "pages"))
    return warc.read_records(index, payloads=False).drop("payload", "url")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbors.search_table(table(spark, sf_dir, "embeddings"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversations, conversation_repair.damaged(conversations))


def op13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder)
    return token_files.checksums(token_files.read_tokens(spark, folder))


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_warc": op2_warc,
    "op3_quality": op3_quality,
    "op4_simhash": op4_simhash,
    "op5_neighbors": op5_neighbors,
    "op6_urls": op6_urls,
    "op7_vectors": op7_vectors,
    "op8_sharding": op8_sharding,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op11_trie": op11_trie,
    "op12_repair": op12_repair,
    "op13_tokens": op13_tokens,
}
