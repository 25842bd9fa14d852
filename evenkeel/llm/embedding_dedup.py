"""Near-duplicate vectors by sorted projection passes.

A pass gives each vector a code of random hyperplane sides and orders the vectors of a group (label) by it. The order is
cut into blocks; vectors in the same or in neighbouring blocks are compared, so every vector meets at least a block's
length of neighbours to either side. Passes with other hyperplanes make up for pairs that a side keeps apart; their
number follows from the rows so that a pair at the threshold is missed by all of them once in ten thousand times.

Where a row links with a visible part of the next block, every pass goes on from its block to farther ones, twice as far
each time, for as long as that holds, so a group of copies larger than the window is compared as a whole by each pass that
keeps it together. All passes go on at once. A pair met by several counts in the first round that meets it, and there in
the first pass, which the rows' block numbers and how far each block has gone tell. Pairs never leave the task: a block
hands on its link counts and a spanning forest. Equal vectors are one entry with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import attach
from evenkeel.llm.components import component_roots
from evenkeel.llm.simhash import Forest
from evenkeel.llm.vectors import matrix, usable, within_one
from evenkeel.staging import stage

THRESHOLD = 0.98
BLOCK = 1024
TOGETHER = 8
BITS = 62
MISSED = 1e-4
MOST_PASSES = 64
SEED = 42
DENSE = 1 / 32
AT_ONCE = 256
COUNTS = "same binary, pass int, linked long, root binary, dense boolean"


def passes_for(rows: int, threshold: float = THRESHOLD, block: int = BLOCK, missed: float = MISSED) -> int:
    """How many passes miss a pair at the threshold with at most the given chance, for so many rows in a group."""
    prefix = max(0, math.ceil(math.log2(max(1.0, 4 * rows / block))))
    together = (1 - math.acos(threshold) / math.pi) ** prefix
    return 1 if together >= 1 - missed else min(MOST_PASSES, math.ceil(math.log(missed) / math.log1p(-together)))


def codes(entries: DataFrame, passes: int, bits: int = BITS, seed: int = SEED) -> DataFrame:
    """``(same, pass, grp, length, code)``: every entry's code in every pass."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = np.int64(1) << np.arange(bits - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column(2)], dtype=np.int64)
            for length in np.unique(lengths):
                rows = pa.array(np.flatnonzero(lengths == length))
                part = batch.take(rows)
                if length not in planes:
                    planes[length] = np.random.default_rng(seed).standard_normal((int(length), passes * bits))
                sides = (within_one(matrix(part.column(2))) @ planes[length] > 0).reshape(-1, passes, bits)
                code = (sides * weights).sum(axis=2)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(np.full(len(rows), length)),
                        pa.array(list(code), pa.list_(pa.int64())),
                    ],
                    ["same", "grp", "length", "codes"],
                )

    coded = entries.select("same", "grp", "vector").mapInArrow(
        of_batches, "same binary, grp string, length long, codes array<long>"
    )
    return coded.select("same", "grp", "length", F.posexplode("codes").alias("pass", "code"))


def blocks(coded: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(same, blocks)``: the number of each entry's block in every pass; blocks count on over passes and groups."""
    spark = coded.sparkSession
    order = ["pass", "grp", "length", "code", "same"]
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = stage(coded.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()), "slices")
    counts = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))  # one row per slice
    before = counts.select(
        "_slice",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    own = F.row_number().over(Window.partitionBy("_slice").orderBy(*order)) - 1
    placed = sliced.withColumn("_own", own).join(F.broadcast(before), "_slice")
    number = F.floor((F.col("_before") + F.col("_own")) / F.lit(block)).cast("long")
    by_pass = placed.select("same", F.struct("pass", number.alias("block")).alias("at")).groupBy("same").agg(
        F.sort_array(F.collect_list("at")).alias("at")
    )
    return by_pass.select("same", F.col("at.block").alias("blocks"))


def _compare(table: pa.Table, threshold: float, this: int, block: int, reach: int = 0) -> pa.Table:
    """Links that pass ``this`` is the first to meet, of the rows at home with each other in a block and with the next one.

    With ``reach``, blocks at home have met those up to so many ahead and are compared with those from there to twice as
    far; ``reaches`` has how far the row's block in each pass goes, this round included.
    """
    home = table.column("home").to_numpy(zero_copy_only=False)
    weight = table.column("copies").to_numpy()
    at = matrix(table.column("blocks")).astype(np.int64)
    same, group = table.column("same").to_pylist(), table.column("grp").to_pylist()
    lengths = np.array([len(v) for v in table.column("vector")])
    if reach:
        goes = matrix(table.column("reaches")).astype(np.int64)
        went = np.where(goes == 2 * reach, reach, goes)
    else:
        goes, went = np.ones_like(at), np.full_like(at, -1)
    # Passes before this one have met what they reach in this round, later ones what they reached in the last.
    reached = np.concatenate([goes[:, :this], went[:, this:]], axis=1)
    linked, forest, dense = np.zeros(len(home), dtype=np.int64), Forest(len(home)), np.zeros(len(home), dtype=bool)
    kinds: dict[tuple, list[int]] = {}
    for i, kind in enumerate(zip(group, lengths.tolist(), strict=True)):
        kinds.setdefault(kind, []).append(i)
    for rows in map(np.array, kinds.values()):
        vectors = matrix(table.column("vector").take(pa.array(rows)))
        vectors = within_one(vectors)
        vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        for inside, follow in _neighbours(home[rows], at[rows, this], reach):
            for start in range(0, len(inside), AT_ONCE):
                left = inside[start : start + AT_ONCE]
                right = follow if reach else np.concatenate([inside[start:], follow])
                if not len(right):
                    continue
                close = vectors[left] @ vectors[right].T >= threshold
                own = len(right) - len(follow)
                dense[rows[left[close[:, own:].sum(axis=1) >= DENSE * block]]] = True
                close[:, :own] &= right[None, :own] > left[:, None]  # followers are compared with every row
                i, j = np.nonzero(close)
                a, b = _unmet(rows[left[i]], rows[right[j]], at, reached, this)
                forest.add(a, b)
                np.add.at(linked, a, weight[b])
                np.add.at(linked, b, weight[a])
    labels = forest.flush()
    told = np.flatnonzero((linked > 0) | (labels != np.arange(len(labels))) | dense)
    return pa.table({
        "same": pa.array([same[i] for i in told], pa.binary()),
        "pass": pa.array(np.full(len(told), this, dtype=np.int32)),
        "linked": pa.array(linked[told]),
        "root": pa.array([same[labels[i]] for i in told], pa.binary()),
        "dense": pa.array(dense[told]),
    })


def _neighbours(home: np.ndarray, block: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each block at home and those of the block after it; with ``reach``, of each from there to twice as far."""
    for b in np.unique(block[home]):
        inside = np.flatnonzero(home & (block == b))
        if not reach:
            yield inside, np.flatnonzero(block == b + 1)
            continue
        for far in np.unique(block[~home & (block > b + reach) & (block <= b + 2 * reach)]):
            yield inside, np.flatnonzero(~home & (block == far))


def _unmet(
    a: np.ndarray, b: np.ndarray, at: np.ndarray, reached: np.ndarray, this: int
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that no other pass reaches from the earlier of the two blocks."""
    for other in range(at.shape[1]):
        if other == this or not len(a):
            continue
        ahead = at[b, other] - at[a, other]
        apart = np.abs(ahead) > np.where(ahead >= 0, reached[a, other], reached[b, other])
        a, b = a[apart], b[apart]
    return a, b


def _comparing(threshold: float, block: int, reach: int = 0) -> Callable[[tuple, pa.Table], pa.Table]:
    return lambda keys, t: _compare(t, threshold, keys[0].as_py(), block, reach)


def link_counts(
    entries: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, passes: int | None = None
) -> DataFrame:
    """``(same, linked, root)``: parts of the number of linked rows, and links of a spanning forest, for
    ``entries (same, grp, vector, copies)``."""
    if passes is None:
        largest = entries.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
        passes = passes_for(largest, threshold, block)
    at = blocks(codes(entries, passes), block)
    rows = stage(entries.join(at, "same"), "blocks")
    columns = ["same", "grp", "vector", "copies", "blocks"]
    # A task has some blocks in a row and the one that follows them. Blocks count on over passes, so a block that two
    # passes share is split by the pass.
    of = F.floor(F.col("_block") / F.lit(TOGETHER))
    at_home = F.struct(of.alias("_at"), F.lit(True).alias("home"))
    following = F.struct((of - 1).alias("_at"), F.lit(False).alias("home"))
    meets = F.when(F.col("_block") % TOGETHER == 0, F.array(at_home, following)).otherwise(F.array(at_home))
    met = rows.select("*", F.posexplode("blocks").alias("pass", "_block")).withColumn("_meet", F.explode(meets))
    found = met.select(*columns, "pass", "_meet.*").groupBy("pass", "_at").applyInArrow(
        _comparing(threshold, block), COUNTS
    )
    found = stage(found, "links")
    parts, reach, gone = [found], 1, None
    dense = found.where("dense").select("same", "pass").distinct()
    places = rows.select("same", F.posexplode("blocks").alias("pass", "_block"))
    while not dense.isEmpty():
        # Blocks with dense rows go on to blocks reach + 1 to 2 reach ahead, in tasks of some blocks to either side.
        ahead = stage(places.join(dense, ["same", "pass"]).select("pass", "_block").distinct(), "ahead")
        now = ahead.withColumn("_reach", F.lit(2 * reach).cast("long"))
        gone = now if gone is None else gone.unionByName(now)
        far = F.explode(F.sequence(F.col("_block") + reach + 1, F.col("_block") + 2 * reach))
        pairs = ahead.withColumn("_far", far).withColumns({
            "_at": F.floor(F.col("_block") / F.lit(TOGETHER)), "_to": F.floor(F.col("_far") / F.lit(TOGETHER))
        })
        sides = pairs.select("pass", "_block", "_at", "_to", F.lit(True).alias("home")).unionByName(
            pairs.select("pass", F.col("_far").alias("_block"), "_at", "_to", F.lit(False).alias("home"))
        ).distinct()
        furthest = gone.groupBy("pass", "_block").agg(F.max("_reach").alias("_reach"))
        of_row = places.join(furthest, ["pass", "_block"]).groupBy("same").agg(
            F.map_from_entries(F.collect_list(F.struct("pass", "_reach"))).alias("_reaches")
        )
        reaches = F.transform(
            "blocks", lambda _, i: F.coalesce(F.try_element_at(F.col("_reaches"), i), F.lit(1).cast("long"))
        )
        reached = rows.join(of_row, "same", "left").select(*columns, reaches.alias("reaches"))
        more = places.join(sides, ["pass", "_block"]).drop("_block").join(reached, "same")
        more = more.select(*columns, "reaches", "pass", "_at", "_to", "home").groupBy("pass", "_at", "_to").applyInArrow(
            _comparing(threshold, block, reach), COUNTS
        )
        more = stage(more, "links")
        parts.append(more)
        dense = more.where("dense").select("same", "pass").distinct()
        reach *= 2
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("same", "linked", "root")


def near_duplicates(
    embeddings: DataFrame,
    threshold: float = THRESHOLD,
    block: int = BLOCK,
    passes: int | None = None,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row.

    Rows without a label, or whose vector is null, empty or zero or has null or non-finite components, link with
    nothing, and vectors of different lengths do not link. Equal vectors of a label link with each other. A component is
    named by its smallest id; ``kept`` marks the rows that carry it. Null ids name no component unless it has no other.
    Repeated rows stay. An empty table gives an empty result. Extra columns are left out.
    """
    rows = stage(
        usable(embeddings, key, vector, label).withColumn("same", F.when(F.col("grp").isNotNull(), F.col("same"))),
        "vectors",
    )
    lonely = rows.where(F.col("same").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    entries = stage(
        rows.where(F.col("same").isNotNull()).groupBy("same").agg(
            F.first("grp").alias("grp"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min(
                "vec_id"
            ).alias("least")
        ),
        "entries",
    )
    parts = stage(
        link_counts(entries.select("same", "grp", "vector", "copies"), threshold, block, passes), "link-counts"
    )
    # Components work on numbers; entries are numbered by their place in a written table.
    numbers = stage(
        entries.select("same", "least", "copies").withColumn("node", F.monotonically_increasing_id()), "nodes"
    )
    name = numbers.select("same", "node")
    edges = parts.join(name.withColumnRenamed("node", "a"), "same").join(
        name.select(F.col("same").alias("root"), F.col("node").alias("b")), "root"
    ).select("a", "b")
    roots = component_roots(edges)
    rooted = numbers.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    sums = parts.groupBy("same").agg(F.sum("linked").alias("linked"))
    lookup = rooted.join(names, "root").join(sums, "same", "left").select(
        "same", "copies", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    linked = attach(
        rows.where(F.col("same").isNotNull()).select("vec_id", "same"),
        stage(lookup, "components"),
        "same",
        "copies",
        rows.count(),
    )
    out = linked.select("vec_id", "n_links", "component_id").unionByName(lonely)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
