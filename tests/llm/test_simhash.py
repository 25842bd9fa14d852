from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from evenkeel.llm import queries, simhash
from evenkeel.llm.common import ship
from evenkeel.llm.components import component_roots


def plain_fingerprint(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", low)
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, codes, radius=3):
    labels = np.array(ids)
    while True:
        new = np.array([labels[np.bitwise_count(codes ^ c) <= radius].min() for c in codes])
        if (new == labels).all():
            return labels
        labels = new


@settings(max_examples=200, deadline=None)
@given(st.text("aB É\t\x0b \n", max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) == plain_fingerprint(text)


def clustered(count, seed, spread=5):
    draw = np.random.default_rng(seed)
    codes = [int(x) for x in draw.integers(0, 2**64, count // 4, dtype=np.uint64)]
    while len(codes) < count:
        code = codes[int(draw.integers(len(codes)))]
        for bit in draw.choice(64, int(draw.integers(0, spread)), replace=False):
            code ^= 1 << int(bit)
        codes.append(code)
    return np.unique(np.array(codes, dtype=np.uint64))


@pytest.mark.parametrize(("count", "spread", "levels"), [(500, 5, 0), (3_000, 5, 3), (3_000, 2, 4)])
def test_every_pair_is_met(count, spread, levels):
    codes = clustered(count, count, spread)
    nodes = simhash.fit_tree(codes[::3], levels)
    shard, row, home = simhash.route(codes, nodes, 3)
    assert sorted(row[home]) == list(range(len(codes)))
    labels = np.arange(len(codes))
    edges = []
    for s in np.unique(shard):
        own, at_home = row[shard == s], home[shard == s]
        order = np.lexsort((own, ~at_home))
        own, at_home = own[order], at_home[order]
        found = simhash.link_shard(codes[own], at_home, 3)
        edges += list(zip(own, own[found], strict=True))
    forest = simhash.Forest(len(codes))
    forest.add(*(np.array(x) for x in zip(*edges, strict=True)))
    labels = forest.flush()
    assert (labels == plain_components(range(len(codes)), codes)).all()


def test_links_over_shards(spark):
    ship(spark)
    codes = clustered(2_000, 5)
    frame = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code long")
    roots = {r["node"]: r["root"] for r in component_roots(simhash.links(frame, shard_codes=200, sample=400)).collect()}
    mine = np.array([roots.get(int(c), int(c)) for c in codes.view(np.int64)])
    assert (mine == plain_components(codes.view(np.int64), codes)).all()


def test_components_of_awkward_graphs(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1_000, i) for i in range(1_001, 1_400)]
    rows = [*chain, *star, (5, 5), (None, 3), (7, 6), (7, 6)]
    roots = {r["node"]: r["root"] for r in component_roots(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert roots == {i: 0 for i in range(1, 201)} | {i: 1_000 for i in range(1_001, 1_400)}
    assert component_roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark):
    ship(spark)
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(5, base, "x"), (3, base + " more", "x"), (9, base.upper(), "x"), (1, None, "x"), (2, " \t", "x"), (4, "solo", "x"),
            (4, "solo", "x"), (None, "solo", "x"), (None, "nobody else has this text here", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, code string")
    found = [tuple(r) for r in simhash.near_duplicates(frame).collect()]
    assert len(found) == len(rows)
    for doc, fingerprint, component in found:
        assert fingerprint in {f"{plain_fingerprint(t):016x}" for d, t, _ in rows if d == doc}
        if doc is not None:
            assert component == {5: 3, 3: 3, 9: 3, 1: 1, 2: 1, 4: 4}[doc]
    assert sorted(str(c) for d, _, c in found if d is None) == ["4", "None"]
    kept = simhash.distinct_documents(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "4", "None"]
    assert simhash.near_duplicates(frame.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op4_simhash"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    codes = np.array([int(r["fingerprint"], 16) for r in rows], dtype=np.uint64)
    assert all(int(r["fingerprint"], 16) == plain_fingerprint(texts[r["doc_id"]]) for r in rows[::20])
    assert (plain_components([r["doc_id"] for r in rows], codes) == [r["component_id"] for r in rows]).all()
