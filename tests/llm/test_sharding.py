from __future__ import annotations

import heapq
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evenkeel.llm import queries, sharding
from evenkeel.llm.common import ship


def loads(sizes, shard, shards, base=None):
    return np.bincount(shard, weights=sizes, minlength=shards) + (0 if base is None else base)


def greedy(sizes, shards):
    heap = [0] * shards
    for s in sorted(sizes, reverse=True):
        heapq.heapreplace(heap, heap[0] + s)
    return max(heap) - min(heap)


def plain_differencing(sizes, shards):
    """The final spread by the textbook, on lists."""
    parts = [sorted([0] * (shards - 1) + [s]) for s in sizes] or [[0] * shards]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1])
        a, b = parts.pop(0), parts.pop(0)
        joined = sorted(x + y for x, y in zip(a, reversed(b), strict=True))
        parts.append([x - joined[0] for x in joined])
    return parts[0][-1] - parts[0][0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 10_000), min_size=1, max_size=40, unique=True), st.integers(2, 6))
def test_differencing(sizes, shards):
    shard = sharding.difference(np.array(sizes), shards)
    assert shard.min() >= 0 and shard.max() < shards
    filled = loads(sizes, shard, shards)
    assert filled.sum() == sum(sizes)
    if len({p for p in sizes}) == len(sizes) and len(sizes) <= shards:
        assert sorted(filled)[-len(sizes) :] == sorted(sizes)


def test_spread_is_the_textbooks_and_tighter_than_greedy():
    draw = np.random.default_rng(0)
    for shards in (2, 3, 5):
        sizes = draw.integers(10_000, 1_000_000, 60)
        filled = loads(sizes, sharding.difference(sizes, shards), shards)
        assert filled.max() - filled.min() == plain_differencing(sizes.tolist(), shards)
        assert filled.max() - filled.min() <= greedy(sizes.tolist(), shards)


def test_loads_are_filled_up():
    sizes = np.random.default_rng(1).integers(1, 100, 2_000)
    base = np.array([9_000, 0, 100_000, 500])
    filled = loads(sizes, sharding.difference(sizes, 4, base), 4, base)
    others = np.delete(filled, 2)
    assert filled[2] == 100_000 and others.max() - others.min() <= 2


@pytest.mark.parametrize("lots", [50, 100_000])
def test_documents(spark, lots, monkeypatch):
    ship(spark)
    monkeypatch.setattr(sharding, "LOT_GROUPS", lots)
    draw = np.random.default_rng(2)
    rows = [(i, "x" * int(draw.integers(0, 400)) + str(i % 300)) for i in range(900)]
    rows += [(5_000 + i, "the same hot text") for i in range(450)] + [
        (None, None), (1, None), (2, ""), (7, "é"), (7, "é")
    ]
    frame = spark.createDataFrame([(*r, 0, "k") for r in rows], "doc_id long, text string, shard int, key string")
    found = sharding.shard_documents(frame, shards=7).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows
    )
    of_text, slots, filled = {}, {}, Counter()
    for r in found:
        of_text.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
        slots.setdefault(r["shard"], []).append(r["slot"])
        filled[r["shard"]] += r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(filled.values()) - min(filled.values()) < 0.02 * sum(filled.values()) / 7


def test_empty_and_single(spark):
    ship(spark)
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [(r["size"], r["slot"]) for r in sharding.shard_documents(frame).collect()] == [(17, 0)]
    assert sharding.shard_documents(frame.limit(0)).count() == 0


def test_query(spark):
    found = queries.QUERIES["op8_sharding"](spark, "/root/testdata/sf0.01").collect()
    filled = Counter()
    for r in found:
        filled[r["shard"]] += r["size"]
    assert len(found) == 1000 and sorted(filled) == list(range(40))
    assert max(filled.values()) <= 1.01 * sum(filled.values()) / 40
