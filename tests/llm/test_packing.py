from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evenkeel.llm import packing
from evenkeel.llm.common import ship

IDS = packing.Ids("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text("ab 'sré\n\t  <|endoftext|>", max_size=60)))
def test_ids_are_those_of_the_tokenizer(text):
    assert np.array_equal(IDS(text), IDS.exact(text))


def test_special_tokens_in_a_text():
    text = "a <|endoftext|> b"
    assert list(IDS(text)) == IDS.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 100), st.integers(0, 100)), min_size=1, max_size=80))
def test_sequences_respect_every_limit(pairs):
    sizes = np.array([(t, 1, min(t, loss)) for t, loss in pairs])
    limits = np.array([100, 5, 60])
    sequence, rank = packing.place(sizes, limits)
    for s in range(sequence.max() + 1):
        members = np.flatnonzero(sequence == s)
        assert sorted(rank[members]) == list(range(len(members)))
        assert (sizes[members].sum(axis=0) <= limits).all() or len(members) == 1
    assert len(set(sequence)) == sequence.max() + 1


def test_little_is_left_open():
    sizes = np.random.default_rng(0).integers(1, 1024, (5_000, 1))
    sequence, _ = packing.place(sizes, np.array([1024]))
    assert (sequence.max() + 1) * 1024 < 1.01 * sizes.sum()


def test_each_limit_can_bind(spark):
    rows = spark.createDataFrame(
        [(i, 10, 1, i % 2 * 10) for i in range(40)], "id int, tokens long, segments long, loss long"
    )
    packed = packing.pack(rows, {"tokens": 100, "segments": 4, "loss": 20}).collect()
    by = Counter(r["sequence_id"] for r in packed)
    loss = Counter()
    for r in packed:
        loss[r["sequence_id"]] += r["loss"]
    assert len(packed) == 40 and max(by.values()) == 4 and max(loss.values()) <= 20 and len(by) == 10


def test_oversize_null_and_repeated_items(spark):
    rows = spark.createDataFrame([(500, "x"), (None, "y"), (3, "z"), (3, "z")], "tokens long, note string")
    packed = packing.pack(rows, {"tokens": 100}).collect()
    assert sorted((r["tokens"] or 0, r["note"]) for r in packed) == [(0, "y"), (3, "z"), (3, "z"), (500, "x")]
    big = next(r for r in packed if r["tokens"] == 500)
    assert all(r["sequence_id"] != big["sequence_id"] for r in packed if r["tokens"] == 3)


@pytest.fixture(scope="module")
def documents(spark):
    ship(spark)
    rows = [
        (1, None, 5), (2, "", 5), (3, "word " * 3000, 5), (3, "word " * 3000, 5), (None, "null key", 5), (4, "tiny", 5)
    ]
    rows += [(100 + i, "some text " * i, 5) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string, length int")


def test_pieces_cover_every_id_once(spark, documents):
    rows = packing.pack_documents(documents, window=64, group_items=30).collect()
    expected = Counter()
    for r in documents.collect():
        ids = np.append(IDS.exact(r["text"] or ""), np.uint32(0)).astype("<u4")
        for row in rows:
            if row["doc_id"] == r["doc_id"] and row["doc_tokens"] == len(ids):
                assert row["ids_crc32"] == zlib.crc32(ids[row["start"] : row["start"] + row["length"]])
        expected[(r["doc_id"], len(ids))] += len(ids)
    found = Counter()
    for r in rows:
        found[(r["doc_id"], r["doc_tokens"])] += r["length"]
    assert found == expected
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64


def test_empty_table(spark, documents):
    empty = packing.pack_documents(documents.limit(0))
    assert empty.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert empty.count() == 0


@pytest.mark.parametrize("text", ["", "a b c"])
def test_many_very_short_texts_fill_their_sequences(spark, text):
    ship(spark)
    rows = spark.range(10_000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    packed = packing.pack_documents(rows).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("pieces"))
    used, sequences = packed.agg(F.sum("n"), F.count("*")).first()
    assert used > 0.9 * 1024 * (sequences - 1)
    capped = packing.pack_documents(rows, segments=100).groupBy("sequence_id").count()
    assert capped.agg(F.max("count")).first()[0] == 100
