"""Shards of nearly equal bytes by Karmarkar-Karp differencing; documents with equal texts stay together.

A partial partition is one load per shard. The two with the largest spread are combined again and again, the fullest
shard of one with the emptiest of the other, until one is left.

Groups that weigh a visible part of a shard are few, whatever the corpus; they are differenced first. The many small
ones are dealt into even lots, and each lot is differenced in its own task together with its part of the loads that
the large groups leave, so that small groups fill up what large ones leave open.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import attach, by_group, dealt, shares, slots
from evenkeel.staging import stage

SHARDS = 40
OVERHEAD = 16
LARGE_PARTS = 50
LOT_GROUPS = 20_000


def difference(sizes: np.ndarray, shards: int, loads: np.ndarray | None = None) -> np.ndarray:
    """The shard of each size. ``loads`` is what the shards hold already, by number.

    The partial partition of an item has its size in one shard and nothing in the others; ``loads`` is one more of
    them. Equal spreads are taken in order.
    """
    base = np.zeros(shards, dtype=np.int64) if loads is None else np.asarray(loads, dtype=np.int64)
    base_order = np.argsort(base, kind="stable")
    values: list[np.ndarray | int | None] = [int(s) for s in sizes]  # a single item is kept as its size
    values.append(base[base_order] - base.min())
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heap.append((-int(base.max() - base.min()), len(sizes)))
    heapq.heapify(heap)

    def row(i: int) -> np.ndarray:
        value, values[i] = values[i], None
        if isinstance(value, int):
            whole = np.zeros(shards, dtype=np.int64)
            whole[-1] = value
            return whole
        return value

    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, i = heapq.heappop(heap)
        _, j = heapq.heappop(heap)
        joined = row(i) + row(j)[::-1]
        order = np.argsort(joined, kind="stable")
        joined = joined[order]
        merges.append((i, j, order))
        values.append(joined - joined[0])
        heapq.heappush(heap, (-int(joined[-1] - joined[0]), len(values) - 1))

    places: dict[int, np.ndarray] = {heap[0][1]: np.arange(shards)}
    shard = np.empty(len(sizes), dtype=np.int64)
    at_base = np.arange(shards)
    for n in range(len(merges) - 1, -1, -1):
        i, j, order = merges[n]
        place = places.pop(len(sizes) + 1 + n)
        first = np.empty(shards, dtype=np.int64)
        first[order] = place
        for child, its in ((i, first), (j, first[::-1])):
            if child < len(sizes):
                shard[child] = its[-1]
            elif child == len(sizes):
                at_base = its
            else:
                places[child] = its
    name = np.empty(shards, dtype=np.int64)
    name[at_base] = base_order
    return name[shard]


def assign(
    groups: DataFrame, shards: int = SHARDS, large_parts: int = LARGE_PARTS, lot_groups: int = LOT_GROUPS
) -> DataFrame:
    """``groups (key, bytes, copies)`` with their ``shard``.

    On the driver are the groups of at least one ``large_parts``-th of a mean shard: at most ``shards * large_parts``.
    """
    totals = groups.agg(F.sum("bytes"), F.count(F.lit(1))).first()
    total, count = int(totals[0] or 0), totals[1]
    bound = shards * large_parts
    is_large = F.col("bytes") * bound >= F.lit(total)
    large = groups.where(is_large).select("key", "bytes").orderBy(F.desc("bytes"), "key").limit(bound).collect()
    sizes = np.array([r["bytes"] for r in large], dtype=np.int64)
    placed = difference(sizes, shards)
    loads = np.bincount(placed, weights=sizes, minlength=shards) if len(large) else np.zeros(shards)
    rest = total - int(sizes.sum())

    def of_lot(lot: pa.Table) -> pa.Table:
        lot = lot.sort_by([("bytes", "descending"), ("key", "ascending")])
        own = lot.column("bytes").to_numpy()
        part = np.floor(loads * (own.sum() / rest)).astype(np.int64)
        return lot.drop_columns(["_lot"]).append_column(
            "shard", pa.array(difference(own, shards, part).astype(np.int32))
        )

    schema = "key binary, bytes long, copies long, shard int"
    lots = shares(count, lot_groups)
    spread = groups.where(~is_large).select("key", "bytes", "copies", dealt("key", lots).alias("_lot"))
    small = by_group(spread, lots, "_lot").groupBy("_lot").applyInArrow(of_lot, schema)
    rows = [(bytes(r["key"]), int(s)) for r, s in zip(large, placed, strict=True)]
    numbers = groups.sparkSession.createDataFrame(rows, "key binary, shard int")
    return small.unionByName(
        groups.where(is_large).select("key", "bytes", "copies").join(F.broadcast(numbers), "key").select(
            "key", "bytes", "copies", "shard"
        )
    )


def shard_documents(documents: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` per document under the law ``bytes``.

    Null texts count as empty, and both are one group. Null and repeated keys stay; rows that are equal in every column
    may swap slots. A group larger than a mean shard has a shard to itself as far as the others can take the rest.
    An empty table gives an empty result. ``grown_shard`` belongs to another law and is null.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stage(documents.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(body)).alias("key"),
    ), "shard-rows")
    groups = stage(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("copies")), "groups")
    placed = stage(assign(groups, shards), "placed").select("key", "copies", "shard")
    numbered_rows = slots(
        attach(rows, placed, "key", "copies", rows.count()), "shard", ["doc_id", "size", "text_crc32"]
    )
    return numbered_rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
