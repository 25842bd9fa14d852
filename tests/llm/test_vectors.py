from __future__ import annotations

import re

import numpy as np
import pytest
from compare import assert_same, duck

from evenkeel.llm import embedding_dedup, neighbors, queries
from evenkeel.llm.common import ship

SF = "/root/testdata/sf0.01"


def test_walk_goes_by_summed_distance():
    draw = np.random.default_rng(0)
    for shape in ((1, 1), (1, 5), (4, 3), (8, 8)):
        a, b = draw.random(shape[0]).round(1), draw.random(shape[1]).round(1)
        pairs = list(neighbors.walk(a, b))
        sums = [a[i] + b[j] for i, j in pairs]
        assert sorted(pairs) == [(i, j) for i in range(shape[0]) for j in range(shape[1])]
        assert sums == sorted(sums)


def exact(ids, vectors, query, k=10):
    scores = np.sqrt(((vectors - vectors[ids.index(query)]) ** 2).sum(axis=1))
    return sorted((float(s), i) for s, i in zip(scores, ids, strict=True) if i != query)[:k]


def test_recall_of_the_query(spark):
    ship(spark)
    rows = queries.QUERIES["op5_neighbors"](spark, "/root/testdata/sf0.1").collect()
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, vectors = [r["vec_id"] for r in table], np.array([r["embedding"] for r in table], dtype=float)
    found, hits = {}, 0
    for r in rows:
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    assert sorted(found) == [i for i in sorted(ids) if i % 100 == 0]
    for query, got in found.items():
        got.sort()
        assert [g[0] for g in got] == list(range(1, 11)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
        want = exact(ids, vectors, query)
        hits += len({v for _, v in want} & {v for _, _, v in got})
        at = {v: k for k, v in enumerate(ids)}
        for _, score, v in got:
            assert score == pytest.approx(np.linalg.norm(vectors[at[v]] - vectors[at[query]]), abs=1e-12)
    assert hits >= 0.9 * 10 * len(found)


def test_part_of_the_cells_is_enough_on_clusters(spark):
    ship(spark)
    draw = np.random.default_rng(2)
    centres = draw.standard_normal((30, 8)) * 20
    vectors = centres[draw.integers(30, size=6_000)] + draw.standard_normal((6_000, 8))
    frame = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"
    )
    rows = neighbors.usable(frame, group=None).cache()
    asked = rows.where("vec_id % 100 = 0")
    index = neighbors.build(rows, shard_rows=500)
    enough = neighbors.rows_for_recall(index, asked)
    assert enough < 3_000
    found = neighbors.search(index, asked, enough, block_queries=20).collect()
    want = {(q, v) for q in range(0, 6_000, 100) for _, v in exact(list(range(6_000)), vectors, q)}
    assert len(want & {(r["query_id"], r["vec_id"]) for r in found}) >= 0.9 * len(want)


def test_neighbours_of_awkward_rows(spark):
    ship(spark)
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(0, 500, 10)]  # copies: ties go to the smallest ids
    rows += [(700, [1.0, 2.0, 4.0], 1), (701, None, 1), (702, [0.0, 0.0, 0.0], 1), (703, [1.0, float("nan"), 0.0], 1),
             (704, [1.0, None, 2.0], 1), (705, [1.0, 2.0], 1), (None, [1.0, 2.0, 3.5], 1), (700, [1.0, 2.0, 4.0], 1), (706, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    found = {}
    for r in neighbors.search_table(frame).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == [0, 100, 200, 300, 400, 700]
    assert [v for _, v, _ in sorted(found[100])] == [0, 10, 20, 30, 40, 50, 60, 70, 80, 90]
    assert [v for _, v, _ in sorted(found[700])] == list(range(0, 100, 10)) and sorted(found[700])[0][2] == 1.0
    few = neighbors.search_table(frame.where("vec_id in (100, 700, 10)"))
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in few.collect()) == [
        (100, 1, 10), (100, 2, 700), (700, 1, 10), (700, 2, 100)
    ]
    assert neighbors.search_table(frame.limit(0)).count() == 0
    assert neighbors.search_table(frame.where("vec_id = 701")).count() == 0


def test_ties_go_to_the_smaller_ids_beyond_the_rows_kept(spark):
    ship(spark)
    # 60 distinct vectors at distance 1 from the query's, ids against the order of any sum; and near copies of a long one.
    tied = [(1_000 - i, [1.0 if j == i else 0.0 for j in range(60)]) for i in range(60)]
    frame = spark.createDataFrame([(100, [0.5 / 60] * 60), *tied], "vec_id long, embedding array<double>")
    found = neighbors.search_table(frame).where("query_id = 100").orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == list(range(941, 951))
    draw = np.random.default_rng(7)
    steps = draw.permutation(200) + 1
    long = [(1_001 + i, [1e8, float(s) / 64]) for i, s in enumerate(steps)]
    frame = spark.createDataFrame([(100, [1e8, 0.0]), *long], "vec_id long, embedding array<double>")
    found = neighbors.search_table(frame).where("query_id = 100").orderBy("rank").collect()
    assert [r["score"] * 64 for r in found] == list(range(1, 11))


def test_each_length_is_searched_by_itself(spark):
    ship(spark)
    draw = np.random.default_rng(11)
    lengths = [3] * 900 + [5] * 700 + [2] * 60 + [4] * 40
    rows = [(i, draw.standard_normal(lengths[i * 7 % len(lengths)]).tolist()) for i in range(len(lengths))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ready = neighbors.stage(neighbors.usable(frame, group=None), "vectors")
    asked = ready.where("vec_id % 20 = 0")
    found = {}
    for r in neighbors.nearest_neighbours(ready, asked, recall=1.0, shard_rows=300).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {len(rows[q][1]) for q in found} == {2, 3, 4, 5}
    missed = 0
    for query in range(0, len(rows), 20):
        alike = [i for i, v in rows if len(v) == len(rows[query][1])]
        want = exact(alike, np.array([rows[i][1] for i in alike]), query)
        got = sorted(found[query])
        assert [g[0] for g in got] == list(range(1, len(want) + 1))
        assert all(len(rows[v][1]) == len(rows[query][1]) for _, v, _ in got)
        if len(rows[query][1]) in (2, 4):
            assert [v for _, v, _ in got] == [v for _, v in want]
        missed += len({v for _, v in want} - {v for _, v, _ in got})
    assert missed <= 0.02 * 10 * len(found)


def test_candidates_are_the_nearest_of_the_passed_cells():
    draw = np.random.default_rng(12)
    rows, points = draw.random((400, 3)).round(1), draw.random((30, 3)).round(1)  # many ties
    cell = np.sort(draw.integers(0, 20, 400))
    own, first = np.unique(cell, return_index=True)
    last = np.r_[first[1:], len(rows)]
    passes = [draw.choice(25, size=draw.integers(1, 12), replace=False).tolist() for _ in points]  # some cells are not here
    probes = neighbors.pa.table({"cells": passes, "depths": [[10 * c for c in p] for p in passes]})
    told = {}
    for i, row, depth in neighbors._candidates(rows, own, first, last, points, probes, 5):
        assert (depth == 10 * cell[row]).all() and len(set(row.tolist())) == len(row)
        told[i] = set(row.tolist())
    for i, passed in enumerate(passes):
        near = {r: ((rows[r] - points[i]) ** 2).sum() for r in range(400) if cell[r] in passed}
        if not near:
            assert i not in told
            continue
        bound = sorted(near.values())[: min(5, len(near))][-1]
        assert {r for r, d in near.items() if d <= bound} <= told[i]
        assert max(near[r] for r in told[i]) <= bound + 1e-9


def test_entries_go_where_queries_come(spark):
    ship(spark)
    schema = "shard int, cell int, ids array<long>, vector array<double>"
    entries = neighbors.stage(
        spark.createDataFrame([(s, 0, [10 * s + i], [float(i)]) for s in range(4) for i in range(3)], schema), "entries"
    )
    asked = [(1, q, [0.2], [0], [3]) for q in range(7)] + [(2, 7, [1.9], [0], [3])]
    probes = neighbors.stage(spark.createDataFrame(asked, neighbors.PROBES), "probes")
    best = neighbors._best(entries, probes, 2, block_queries=3)
    rows = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in best.collect())
    assert rows == [(q, k, 9 + k) for q in range(7) for k in (1, 2)] + [(7, 1, 22), (7, 2, 21)]
    plan = best._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    sides = re.findall(r"Exchange hashpartitioning\(shard#\d+, block#\d+, 4\), (\w+)", plan)
    assert sides == ["REPARTITION_BY_NUM"] * 2  # one shuffle of each side, into as many tasks as groups


def test_vectors_of_length_one(spark):
    ship(spark)
    rows = spark.range(300).selectExpr("id as vec_id", "array(double(id + 1)) as embedding")
    found = neighbors.search_table(rows).where("query_id = 100").orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found[:4]] == [(99, 1.0), (101, 1.0), (98, 2.0), (102, 2.0)]


def plain_links(rows, threshold=0.98):
    ids = [r[0] for r in rows]
    good = [
        r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(
            x is not None and np.isfinite(x) for x in r[1]
        ) and any(r[1]) for r in rows
    ]
    counts, neighbours = [0] * len(rows), [[] for _ in rows]
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and good[i] and good[j] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    counts[i] += 1
                    neighbours[i].append(j)
    labels = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            least = min([labels[i], *[labels[j] for j in neighbours[i]]])
            changed |= least != labels[i]
            labels[i] = least
    names = [
        min(
            (ids[j] for j in range(len(rows)) if labels[j] == labels[i] and ids[j] is not None), default=None
        ) for i in range(len(rows))
    ]
    return sorted((str(i), n, str(c)) for i, n, c in zip(ids, counts, names, strict=True))


@pytest.mark.parametrize(("block", "passes"), [(1024, None), (8, 16)])
def test_links_against_brute_force(spark, block, passes):
    ship(spark)
    draw = np.random.default_rng(3)
    rows = []
    for centre in draw.standard_normal((12, 16)):
        for _ in range(int(draw.integers(1, 30))):
            rows.append((len(rows), (centre + draw.standard_normal(16) * 0.09).tolist(), len(rows) % 2))
    rows += [(900 + i, rows[0][1], 0) for i in range(40)]  # copies
    rows += [(990, rows[0][1], None), (991, None, 0), (992, [0.0] * 16, 0), (993, [1.0, None], 0), (994, [1.0, 2.0], 0),
             (995, [1.0, 2.001], 0), (996, [float("inf")] * 16, 0), (None, rows[1][1], 1), (5, rows[5][1], 1)]
    frame = spark.createDataFrame(
        [(*r, 0.0) for r in rows], "vec_id long, embedding array<double>, label int, n_links double"
    )
    found = embedding_dedup.near_duplicates(frame, block=block, passes=passes).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in found) == plain_links(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_dense_group_larger_than_the_window(spark):
    ship(spark)
    draw = np.random.default_rng(4)
    near = draw.standard_normal(32) + draw.standard_normal((400, 32)) * 0.02
    other = draw.standard_normal((400, 32))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([near, other]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {
        r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(
            frame, block=32
        ).collect()
    }
    assert sum(found[i][0] for i in range(400)) >= 0.99 * 400 * 399 and all(found[i][0] <= 399 for i in range(400))
    assert all(found[i] == (0, i) for i in range(400, 800)) and {found[i][1] for i in range(400)} == {0}


@pytest.mark.parametrize("passes", [3, None])
def test_dense_group_that_the_first_plane_cuts(spark, passes):
    ship(spark)
    draw = np.random.default_rng(4)
    drawn = passes or embedding_dedup.passes_for(800, block=32)
    planes = np.random.default_rng(embedding_dedup.SEED).standard_normal((32, drawn * embedding_dedup.BITS))
    first = planes[:, 0] / np.linalg.norm(planes[:, 0])
    centre = draw.standard_normal(32)
    near = centre - (centre @ first) * first + draw.standard_normal((400, 32)) * 0.01
    assert 150 < (near @ first > 0).sum() < 250
    vectors = np.concatenate([near, draw.standard_normal((400, 32))])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {
        r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(
            frame, block=32, passes=passes
        ).collect()
    }
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = (unit @ unit.T >= embedding_dedup.THRESHOLD).sum(axis=1) - 1
    assert [found[i][0] for i in range(800)] == links.tolist() and links[:400].min() == 399
    assert [found[i][1] for i in range(800)] == [0] * 400 + list(range(400, 800))


def test_more_rows_need_more_passes():
    counts = [embedding_dedup.passes_for(n) for n in (10, 10_000, 10_000_000, 10**12)]
    assert counts == sorted(counts) and counts[0] == 1 and counts[-1] <= embedding_dedup.MOST_PASSES


def test_query(spark):
    assert assert_same(queries.QUERIES["op7_vectors"](spark, SF), duck(SF).sql(queries.ORACLES["op7_vectors"])) == 500


def test_very_small_and_large_vectors(spark):
    """Cosines do not depend on the vectors' size, down to the smallest and up to the largest doubles."""
    rows = []
    for n, scale in enumerate([1e-320, 1e-200, 1e-160, 1.0, 1e160, 1e200, 1e307]):
        rows += [(10 * n, [scale, 3 * scale], f"{n}"), (10 * n + 1, [3 * scale, scale], f"{n}"), (10 * n + 2, [2 * scale, 6 * scale], f"{n}")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect()}
    for n in range(7):
        assert [found[10 * n + i] for i in range(3)] == [(1, 10 * n), (0, 10 * n + 1), (1, 10 * n)]
