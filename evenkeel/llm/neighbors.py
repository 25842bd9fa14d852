"""Approximate nearest neighbours with an inverted multi-index.

Both halves of a vector are quantised by themselves, so few centroids make many cells. A query walks through the pairs
of centroids by the sum of its two squared distances, with a heap, until the cells it has passed hold enough rows; these
are ranked by their exact distance. How many rows are enough is found out on a bounded sample of queries whose exact
neighbours are known: it is what the wanted recall needs there.

Equal vectors are one entry with its smallest ids, as many as can be among the nearest, so copies weigh nothing. Cells
are put into shards of bounded size, large ones into several. A shard is copied for every ``BLOCK_QUERIES`` queries that
come by, and goes nowhere if none does; in it a query is compared with the rows of the cells it passes and no others.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import by_group, shares
from evenkeel.llm.vectors import matrix, usable
from evenkeel.staging import stage

NEAREST = 10
FEWEST_CENTROIDS, MOST_CENTROIDS = 32, 256
SAMPLE = 20_000
ROUNDS = 12
SEED = 42
TRIAL_QUERIES = 128
RECALL = 0.93
LEAST_ROWS = 100
SHARD_ROWS = 20_000
BLOCK_QUERIES = 20_000
AT_ONCE = 256
PROBES = "shard int, query_id long, point array<double>, cells array<int>, depths array<long>"
FOUND = "query_id long, vec_id long, score double, depth long"


def centroids(points: np.ndarray, count: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Lloyd's rounds from seeded points; a centroid without points stays where it is."""
    if not points.shape[1]:
        return np.zeros((1, 0))  # half of a vector of length 1
    distinct = np.unique(points, axis=0)
    centres = distinct[np.random.default_rng(seed).permutation(len(distinct))[:count]]
    for _ in range(rounds):
        nearest = squared(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=len(centres))[:, None]
        centres = np.where(sizes > 0, sums / np.maximum(sizes, 1), centres)
    return centres


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances by the expanded form, good for comparing."""
    return np.maximum((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :], 0)


def rounding(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """For each point, by how much ``squared`` may be off for any of the centres."""
    longest = (centres**2).sum(1).max(initial=0.0)
    terms = 4 * (points.shape[1] + 4)
    return terms * np.finfo(float).eps * (np.sqrt((points**2).sum(1)) + np.sqrt(longest)) ** 2


def walk(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of centroids by summed distance: a pair comes up when both pairs before it in its row and column have."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    done = [0] * len(x)  # how many of a row have come up
    heap = [(x[0] + y[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        done[i] = j + 1
        yield int(a[i]), int(b[j])
        if i + 1 < len(x) and done[i + 1] == j:
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
        if j + 1 < len(y) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))


@dataclass(frozen=True)
class Quantiser:
    first: np.ndarray
    second: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def cell(self, points: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        return squared(points[:, :half], self.first).argmin(1) * len(self.second) + squared(
            points[:, half:], self.second
        ).argmin(1)

    def order(self, point: np.ndarray, sizes: np.ndarray, enough: float) -> list[int]:
        """Cells with rows in the order of the walk, until they hold ``enough`` of them."""
        half, passed, seen = self.first.shape[1], [], 0
        for i, j in walk(squared(point[None, :half], self.first)[0], squared(point[None, half:], self.second)[0]):
            cell = i * len(self.second) + j
            if sizes[cell]:
                passed.append(cell)
                seen += sizes[cell]
                if seen >= enough:
                    break
        return passed


@dataclass(frozen=True)
class Index:
    """Entries ``(shard, cell, ids, vector)`` as a written table; the sizes and shards of the cells."""

    quantiser: Quantiser
    entries: DataFrame
    sizes: np.ndarray
    shard_of: np.ndarray
    shards_of: np.ndarray
    nearest: int

    @property
    def shards(self) -> int:
        return int((self.shard_of + self.shards_of).max()) if len(self.shard_of) else 0


def _once(vectors: DataFrame, nearest: int) -> DataFrame:
    """``(same, ids, vector)``: equal vectors as one entry with the ids that can be among a query's nearest."""
    pairs = vectors.groupBy("same", "vec_id").agg(F.first("vector").alias("vector"))
    smallest = F.row_number().over(Window.partitionBy("same").orderBy("vec_id"))
    few = pairs.withColumn("_n", smallest).where(F.col("_n") <= nearest + 1)
    return few.groupBy("same").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vector").alias("vector")
    )


def build(
    vectors: DataFrame,
    nearest: int = NEAREST,
    count: int | None = None,
    sample: int = SAMPLE,
    shard_rows: int = SHARD_ROWS,
) -> Index | None:
    """The index of ``vectors (vec_id, vector, same)``; the quantiser is fitted on ``sample`` entries or about that.

    ``count`` is the number of centroids of a half, by default the fourth root of the entries within bounds; its square
    is the number of cells, which are counted on the driver. None if there is no vector. Vectors must have one length.
    """
    entries = stage(_once(vectors, nearest), "entries")
    total = entries.count()
    if not total:
        return None
    every = max(1, total // sample)
    picked = entries.where(F.pmod(F.xxhash64("same"), F.lit(every)) == 0).select("vector").limit(2 * sample).toArrow()
    if not picked.num_rows:
        picked = entries.select("vector").limit(sample).toArrow()
    points = matrix(picked.column("vector"))
    points = points[np.lexsort(points.T)]
    half = points.shape[1] // 2
    count = count or min(MOST_CENTROIDS, max(FEWEST_CENTROIDS, int(total**0.25)))
    quantiser = Quantiser(centroids(points[:, :half], count), centroids(points[:, half:], count))

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = quantiser.cell(matrix(batch.column(2))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), batch.column(0), batch.column(1), batch.column(2)],
                    ["cell", "same", "ids", "vector"],
                )

    kind = entries.schema["vector"].dataType.simpleString()
    placed = stage(
        entries.select("same", "ids", "vector").mapInArrow(
            celled, f"cell int, same binary, ids array<long>, vector {kind}"
        ),
        "celled",
    )
    sizes = np.zeros(quantiser.cells, dtype=np.int64)
    for cell, n in placed.groupBy("cell").count().collect():
        sizes[cell] = n
    shard_of, shards_of = np.zeros(len(sizes), dtype=np.int32), np.ones(len(sizes), dtype=np.int32)
    shard, held = 0, 0
    for cell, n in enumerate(sizes):
        if n and held and held + n > shard_rows:
            shard, held = shard + 1, 0
        shard_of[cell], shards_of[cell] = shard, shares(int(n), shard_rows)
        if shards_of[cell] > 1:
            shard, held = shard + int(shards_of[cell]), 0
        else:
            held += n
    place = placed.sparkSession.createDataFrame(
        [(int(c), int(shard_of[c]), int(shards_of[c])) for c in np.flatnonzero(sizes)], "cell int, _first int, _of int"
    )
    sharded = placed.join(F.broadcast(place), "cell").withColumn(
        "shard", (F.col("_first") + F.pmod(F.xxhash64("same"), F.col("_of"))).cast("int")
    )
    return Index(
        quantiser, stage(sharded.select("shard", "cell", "ids", "vector"), "index"), sizes, shard_of, shards_of, nearest
    )


def search(index: Index, queries: DataFrame, enough: float, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``(query_id, rank, vec_id, score, depth)`` for ``queries (vec_id, vector)``: the nearest of the rows passed.

    Rows with the query's own id are left out. ``depth`` is the number of rows in the cells passed up to the result's.
    """
    quantiser, sizes = index.quantiser, index.sizes
    shard_of, shards_of = index.shard_of, index.shards_of

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points, out = matrix(batch.column(1)), []
            for row, (query, point) in enumerate(zip(batch.column(0).to_pylist(), points, strict=True)):
                cells = np.array(quantiser.order(point, sizes, enough), dtype=np.int32)
                depth = np.cumsum(sizes[cells])
                wide = shards_of[cells]
                shard = np.repeat(shard_of[cells], wide) + np.arange(wide.sum()) - np.repeat(
                    np.cumsum(wide) - wide, wide
                )
                order = np.argsort(shard, kind="stable")
                cells, depth, shard = np.repeat(cells, wide)[order], np.repeat(depth, wide)[order], shard[order]
                for some in np.split(np.arange(len(shard)), np.flatnonzero(np.diff(shard)) + 1):
                    out.append((int(shard[some[0]]), query, points[row], cells[some], depth[some]))
            columns = list(zip(*out, strict=True))
            types = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                ["shard", "query_id", "point", "cells", "depths"],
            )

    probes = stage(queries.select("vec_id", "vector").mapInArrow(probe, PROBES), "probes")
    return _best(index.entries, probes, index.nearest, block_queries)


def _best(entries: DataFrame, probes: DataFrame, nearest: int, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The nearest rows for ``probes``, a written table with the cells that a query passes in a shard.

    Both sides are cut into blocks by how many probes come to a shard, so entries are copied as often as their own shard
    needs.
    """
    blocks = F.ceil(F.count(F.lit(1)) / F.lit(block_queries)).cast("int").alias("blocks")
    visits = stage(probes.groupBy("shard").agg(blocks), "visits")
    groups = visits.agg(F.sum("blocks")).first()[0] or 1
    block = F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int").alias("block")
    coming = probes.join(visits, "shard").select("shard", block, "query_id", "point", "cells", "depths")
    spread = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    visited = entries.join(visits, "shard").select("shard", spread, "cell", "ids", "vector")
    key = ["shard", "block"]
    ranked = by_group(visited, groups, *key).groupBy(*key).cogroup(
        by_group(coming, groups, *key).groupBy(*key)
    ).applyInArrow(lambda left, right: _rank(left, right, nearest), FOUND)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return ranked.withColumn("rank", place).where(F.col("rank") <= nearest).select(
        "query_id", "rank", "vec_id", "score", "depth"
    )


def _rank(entries: pa.Table, probes: pa.Table, nearest: int) -> pa.Table:
    """The nearest entries of a shard for each of its probes, among the cells that the probe passes."""
    found: list[tuple] = []
    if entries.num_rows and probes.num_rows:
        entries = entries.sort_by("cell")
        rows, ids = matrix(entries.column("vector")), entries.column("ids").to_pylist()
        own, first = np.unique(entries.column("cell").to_numpy(), return_index=True)
        last = np.r_[first[1:], len(rows)]
        for at in range(0, probes.num_rows, AT_ONCE):
            some = probes.slice(at, AT_ONCE).combine_chunks()
            names, points = some.column("query_id").to_pylist(), matrix(some.column("point"))
            for i, passed, depth in _candidates(rows, own, first, last, points, some, 2 * (nearest + 1)):
                exact = np.sqrt(((rows[passed] - points[i]) ** 2).sum(axis=1))
                best = sorted(
                    (float(s), v, int(d))
                    for s, p, d in zip(exact, passed, depth, strict=True)
                    for v in ids[p]
                    if v is not None and v != names[i]
                )
                found += [(names[i], v, s, d) for s, v, d in best[:nearest]]
    columns = list(zip(*found, strict=True)) or [()] * 4
    types = [pa.int64(), pa.int64(), pa.float64(), pa.int64()]
    arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
    return pa.table(arrays, names=["query_id", "vec_id", "score", "depth"])


def _candidates(
    rows: np.ndarray,
    own: np.ndarray,
    first: np.ndarray,
    last: np.ndarray,
    points: np.ndarray,
    probes: pa.Table,
    keep: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each probe: its number, its ``keep`` nearest rows and all that tie with the last one or may by rounding, and
    how deep they lie. Cell ``own[c]`` has the rows from ``first[c]`` to ``last[c]``; each cell is measured against all
    probes that pass it at once."""
    cells, depths = (probes.column(c).combine_chunks() for c in ("cells", "depths"))
    asker = np.repeat(np.arange(len(points)), np.diff(cells.offsets.to_numpy()))
    cell, depth = cells.flatten().to_numpy(), depths.flatten().to_numpy()
    at = np.searchsorted(own, cell)
    held = at < len(own)  # a cell in several shards may have no row in this one
    held[held] = own[at[held]] == cell[held]
    order = np.flatnonzero(held)[np.argsort(at[held], kind="stable")]
    margin = 2 * rounding(points, rows)
    closest = np.full((len(points), keep), np.inf)
    parts: list[tuple] = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0))]
    for of_cell in np.split(order, np.flatnonzero(np.diff(at[order])) + 1) if len(order) else []:
        c, who = at[of_cell[0]], asker[of_cell]
        near = squared(points[who], rows[first[c] : last[c]])
        closest[who] = np.partition(np.concatenate([closest[who], near], axis=1), keep - 1, axis=1)[:, :keep]
        q, r = np.nonzero(~(near > (closest[who, keep - 1] + margin[who])[:, None]))
        parts.append((who[q], first[c] + r, near[q, r], depth[of_cell][q]))
    who, row, near, deep = (np.concatenate(x) for x in zip(*parts, strict=True))
    kept = np.flatnonzero(~(near > closest[who, keep - 1] + margin[who]))
    kept = kept[np.argsort(who[kept], kind="stable")]
    for of_probe in np.split(kept, np.flatnonzero(np.diff(who[kept])) + 1) if len(kept) else []:
        yield int(who[of_probe[0]]), row[of_probe], deep[of_probe]


def rows_for_recall(index: Index, queries: DataFrame, recall: float = RECALL, trials: int = TRIAL_QUERIES) -> float:
    """How many rows a query must pass for the wanted recall, by the exact neighbours of ``trials`` queries."""
    count = queries.count()
    every = max(1, count // trials)
    some = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(every)) == 0).limit(2 * trials)
    depths = [r[0] for r in search(index, stage(some, "trials"), float("inf")).select("depth").collect()]
    return max(LEAST_ROWS, float(np.quantile(depths, recall)) if depths else 0.0)


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    nearest: int = NEAREST,
    recall: float = RECALL,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each of ``queries (vec_id, vector)`` the nearest of ``vectors``.

    Both as ``usable`` gives them, written tables. Vectors of each length are searched by themselves, as distances exist
    only between them: the most frequent length and all with over ``shard_rows`` vectors by an index each, those of the
    other lengths, which are a shard each, in full. Rows without a vector take no part; null ids are no result. A query
    with fewer candidates than ``nearest`` gets all of them; no vectors or no queries give an empty result. Repeated
    queries of one id count once for each length.
    """
    size = F.size("vector")
    named = F.col("vector").isNotNull() & F.col("vec_id").isNotNull()
    ready = vectors.where(named)
    asked = stage(
        queries.where(named).select("vec_id", "vector", size.alias("length")).dropDuplicates(["vec_id", "length"]),
        "queries",
    )
    counts = ready.groupBy(size.alias("length")).agg(F.count(F.lit(1)).alias("n"))
    most = counts.orderBy(F.desc("n"), "length").limit(1)
    # As many as there are shards' worth of rows, at most.
    lengths = sorted(r["length"] for r in counts.where(F.col("n") > shard_rows).union(most).distinct().collect())
    if not lengths:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rest = _once(ready.where(~size.isin(lengths)), nearest).select(
        F.size("vector").alias("shard"), F.lit(0).alias("cell"), "ids", "vector"
    )
    only_cell = [F.array(F.lit(0)).alias("cells"), F.array(F.lit(0).cast("long")).alias("depths")]
    point = F.col("vector").cast("array<double>").alias("point")
    others = asked.where(~F.col("length").isin(lengths)).select(
        F.col("length").alias("shard"), F.col("vec_id").alias("query_id"), point, *only_cell
    )
    found = _best(rest, others, nearest)
    for length in lengths:
        index = build(ready.where(size == length), nearest, shard_rows=shard_rows)
        of_length = asked.where(F.col("length") == length)
        found = found.unionByName(search(index, of_length, rows_for_recall(index, of_length, recall)))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search_table(embeddings: DataFrame, every: int = 100, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The nearest neighbours of every row whose id is divisible by ``every``, among all rows."""
    rows = stage(usable(embeddings, key, vector, None), "vectors")
    return nearest_neighbours(rows, rows.where(F.col("vec_id") % every == 0))
