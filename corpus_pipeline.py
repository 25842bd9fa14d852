"""The corpus pipeline: documents through five operators, each stage written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm import learning, mixing, packing, quality, simhash, toxicity
from evenkeel.llm.common import ship, table
from evenkeel.staging import stage


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, in all their columns; rows without a label are judged as others.

    A null text counts as empty, equal texts go or stay together, whatever their keys, and a score equal to the
    threshold stays. An empty table stays empty; without labels of both classes all documents have the same score.
    """
    return quality.good_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not call toxic, in all their columns.

    A null text counts as empty, equal texts go or stay together, whatever their keys, and a score equal to the
    threshold goes. An empty table stays empty.
    """
    labels = table(spark, sf_dir, "labels")
    rows = learning.sample(docs, labels, "toxic", toxicity.PER_CLASS, toxicity.HOLDOUT, toxicity.LONGEST)
    return toxicity.clean_documents(docs, toxicity.train(rows))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest key, null keys last, one of rows that tie.

    Null and empty texts are copies of each other. All columns stay, whatever their names. An empty table stays empty.
    """
    ship(spark)
    return simhash.distinct_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as often as their sources' target weights ask for, the last time in part.

    A null source is a source like any other, the last in order. Texts without words have no share and go; equal rows
    are taken each by itself. All columns stay, whatever their names. An empty table stays empty.
    """
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as pieces in sequences, each id in exactly one.

    A null text counts as empty and is one id, the end. Rows that repeat, as mixed rows do, are pieces of their own.
    Other columns are left out. An empty table gives no pieces.
    """
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [("quality", good), ("toxicity", clean), ("distinct", distinct), ("mixed", mixed), ("packed", packed)]

#: The scores come from trained models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
