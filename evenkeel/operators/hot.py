"""Keys that hold a visible part of a table: how they are found, looked up and spread."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Summaries of tasks are folded in so many groups before they meet.
FOLD_GROUPS = 256


def digest(*parts: Column | str) -> Column:
    """16 bytes that stand for some values of any type; null if one of them is null."""
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    sized = [F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.unhex(F.md5(F.concat(*sized)))


def brief(text: Column) -> Column:
    """At most 16 bytes that stand for a text: its own if they are fewer, else a digest of 16; null for null."""
    return F.when(F.octet_length(text) < 16, text.cast("binary")).otherwise(F.unhex(F.md5(text)))


def _trimmed(counts: dict[bytes, int], most: int) -> dict[bytes, int]:
    """A summary cut back to ``most`` counters: the count of the next one is taken from all."""
    if len(counts) <= most:
        return counts
    next_count = sorted(counts.values(), reverse=True)[most]
    return {k: n - next_count for k, n in counts.items() if n > next_count}


def frequent_candidates(keys: DataFrame, key: str, most: int) -> DataFrame:
    """``(key)``: at most ``most`` keys, among them every key that more than one in ``most + 1`` of the rows hold.

    ``key`` is binary; nulls do not count. Each task keeps ``most`` counters, whatever the number of its keys; summaries are
    added up and cut back in groups and then once more, so no task has those of all others.
    """

    def fold(batches: Iterator[pa.RecordBatch], group: int | None = None) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            if group is None:
                found = pc.value_counts(batch.column("key"))
                pairs = zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True)
            else:
                pairs = zip(batch.column("key").to_pylist(), batch.column("n").to_pylist(), strict=True)
            for k, n in pairs:
                if k is not None:
                    counts[k] = counts.get(k, 0) + n
            if len(counts) > 4 * most:
                counts = _trimmed(counts, most)
        counts = _trimmed(counts, most)
        part = TaskContext.get().partitionId() % FOLD_GROUPS if group is None else 0
        if counts:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(counts), pa.int32()),
                    pa.array(list(counts), pa.binary()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["part", "key", "n"],
            )

    schema = "part int, key binary, n long"
    of_tasks = keys.select(F.col(key).alias("key")).mapInArrow(fold, schema)
    of_groups = of_tasks.repartition(FOLD_GROUPS, "part").mapInArrow(lambda b: fold(b, 0), schema)
    return of_groups.repartition(1).mapInArrow(lambda b: fold(b, 0), schema).select(F.col("key").alias(key))


def frequent_keys(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """``(key, n)``: exactly the keys with at least one in ``parts`` of the rows, and their numbers of rows.

    ``key`` is binary, ``rows`` are read twice. There are at most ``parts`` such keys.
    """
    candidates = frequent_candidates(rows.select(key), key, parts)
    total = rows.where(F.col(key).isNotNull()).agg(F.count(F.lit(1)))
    exact = rows.select(key).join(F.broadcast(candidates), key).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return exact.where(F.col("n") * parts >= total.scalar())


def look_up(rows: DataFrame, lookup: DataFrame, key: str, copies: str, total: int, parts: int = 1000) -> DataFrame:
    """Rows with the columns of their key in ``lookup`` (unique by key), null where it has none.

    ``lookup`` says in ``copies`` how many of the ``total`` rows hold the key. The at most ``parts`` keys that hold one in
    ``parts`` of them are broadcast, the others joined by a shuffle in which no key weighs much. ``rows`` are read twice.
    """
    values = [c for c in lookup.columns if c not in (key, copies)]
    is_hot = F.col(copies) * parts >= F.lit(total)
    hot, cold = (lookup.where(c).select(key, *values) for c in (is_hot, ~is_hot))
    hot = hot.limit(parts)
    with_hot = rows.join(F.broadcast(hot), key)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, "left")
    return with_hot.unionByName(others)
