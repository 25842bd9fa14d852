"""Packing of token pieces into sequences: vector bin packing by the dot-product heuristic.

A piece has several sizes at once (tokens, segments, loss-bearing tokens) and a sequence a limit on each. One sequence
is open at a time; of the pieces that still fit, the one with the largest weighted dot product of its sizes and the
space left is placed, which prefers large pieces that use up what is plentiful. The weights are the mean sizes, so a
scarce limit counts more.

Documents are cut at the token limit first. A full piece is a sequence of its own; the rests are dealt into even groups
by row number and packed group by group, so the work is spread and no document or source can fill a group.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import dealt, numbered, shares

WINDOW = 1024
SEGMENTS = 128
GROUP_PIECES = 20_000
END_ID = 0
FULL = 1 << 62  # sequence numbers of full pieces start here
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECES}, sequence_id long, offset long"


@cache
def _encoders(vocabulary: str, ranks: str):
    """The tokenizer, and a faster encoder with the same vocabulary and split pattern."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    with open(public_tokenizers.path(ranks), "rb") as lines:
        table = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    special = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
    return tokenizer, fast, special


class Ids:
    """Ids of texts as ``tokenizers`` gives them.

    The byte-pair merges are those of a second library that is four times as fast; texts with special tokens go to
    ``tokenizers`` itself, and so does the first text of each batch, whose ids must agree.
    """

    def __init__(self, vocabulary: str, ranks: str) -> None:
        self.tokenizer, self.fast, self.special = _encoders(vocabulary, ranks)

    def exact(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def __call__(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return self.exact(text)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)

    def check(self, text: str) -> None:
        if not np.array_equal(self(text), self.exact(text)):
            raise RuntimeError("the two encoders disagree; use tokenizers alone")


def token_pieces(
    documents: DataFrame,
    window: int = WINDOW,
    vocabulary: str = "byte_bpe_50k.json",
    ranks: str = "byte_bpe_50k.tiktoken",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every document as pieces of at most ``window`` ids: its ids, then the end id 0.

    Null texts count as empty and give the end id alone. Null and repeated keys stay as they are: each row is cut by
    itself. Other columns are left out. One scan, no shuffle; ids do not leave the task, only their checksum does.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = Ids(vocabulary, ranks)
        for batch in batches:
            keys, out = batch.column(0).to_pylist(), {n: [] for n in ("doc_id", "start", "length", "crc", "total")}
            if batch.num_rows:
                ids_of.check(batch.column(1)[0].as_py() or "")
            for doc, value in zip(keys, batch.column(1), strict=True):
                ids = np.append(ids_of(value.as_py() or ""), np.uint32(END_ID)).astype("<u4", copy=False)
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    out["doc_id"].append(doc)
                    out["start"].append(start)
                    out["length"].append(len(piece))
                    out["crc"].append(zlib.crc32(piece))
                    out["total"].append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int64()) for v in out.values()],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, PIECES)


def place(sizes: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number of each row of ``sizes`` and its place in that sequence.

    Rows with equal sizes are taken in order. A row over a limit by itself gets a sequence of its own.
    """
    kinds, kind_of = np.unique(sizes, axis=0, return_inverse=True)
    order = np.argsort(kind_of, kind="stable")
    left = np.bincount(kind_of, minlength=len(kinds))
    next_row = np.concatenate([[0], np.cumsum(left)[:-1]])
    shared = kinds / limits
    weighted = shared * (sizes / limits).mean(axis=0)
    sequence, rank = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
    number = -1
    space, placed = limits.copy(), 0
    remaining = len(sizes)
    alive = np.arange(len(kinds))
    while remaining:
        if number < 0:
            fitting = alive
        else:
            fitting = alive[(kinds[alive] <= space).all(axis=1)]
        if number < 0 or not len(fitting):
            number, space, placed = number + 1, limits.copy(), 0
            fitting = alive[(kinds[alive] <= space).all(axis=1)]
            if not len(fitting):
                fitting = alive
        best = fitting[np.argmax(weighted[fitting] @ (space / limits))]
        row = order[next_row[best]]
        next_row[best] += 1
        left[best] -= 1
        if not left[best]:
            alive = alive[alive != best]
        sequence[row], rank[row] = number, placed
        space, placed, remaining = space - kinds[best], placed + 1, remaining - 1
    return sequence, rank


def pack(
    items: DataFrame, limits: Mapping[str, int], tokens: str = "tokens", group_items: int = GROUP_PIECES
) -> DataFrame:
    """Every row of ``items`` with ``sequence_id`` and ``offset`` (tokens before it in its sequence).

    ``limits`` names the size columns (non-negative longs, null counts as 0) and what a sequence may hold of each.
    Rows keep all their columns, whatever their names but the two new ones, and may repeat. A row over a limit by itself
    gets a sequence of its own. An empty table stays empty. The groups set the number of tasks.
    """
    clashing = {"sequence_id", "offset"} & set(items.columns)
    if clashing:
        raise ValueError(f"columns that packing adds: {', '.join(sorted(clashing))}")
    sizes = [F.coalesce(F.col(s).cast("long"), F.lit(0).cast("long")) for s in limits]
    length = F.coalesce(F.col(tokens).cast("long"), F.lit(0).cast("long")).alias("length")
    rows = numbered(items, "pack", F.array(*sizes).alias("demand"), length)
    groups = shares(rows.count(), group_items)
    ceiling = np.array(list(limits.values()), dtype=np.int64)

    def of_group(group: pa.Table) -> pa.Table:
        group = group.sort_by("row").combine_chunks()
        demand = group.column("demand").combine_chunks().flatten().to_numpy().reshape(-1, len(ceiling))
        sequence, rank = place(demand, ceiling)
        length = group.column("length").to_numpy()
        order = np.lexsort((rank, sequence))
        before = np.cumsum(length[order]) - length[order]
        first = np.r_[True, sequence[order][1:] != sequence[order][:-1]]
        offset = np.empty(len(length), dtype=np.int64)
        offset[order] = before - np.repeat(before[first], np.diff(np.r_[np.flatnonzero(first), len(order)]))
        numbers = (np.int64(group.column("group")[0].as_py()) << 32) + sequence
        item = group.column("item").combine_chunks()
        names = [item.type.field(i).name for i in range(item.type.num_fields)]
        return pa.table([*item.flatten(), pa.array(numbers), pa.array(offset)], [*names, "sequence_id", "offset"])

    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return (
        rows.withColumn("group", dealt("row", groups))
        .repartition(groups, "group")
        .groupBy("group")
        .applyInArrow(of_group, f"{plain}, sequence_id long, offset long")
    )


def pack_documents(
    documents: DataFrame,
    window: int = WINDOW,
    segments: int | None = None,
    loss: int | None = None,
    group_items: int = GROUP_PIECES,
) -> DataFrame:
    """Sequences of at most ``window`` ids, ``segments`` pieces and ``loss`` loss-bearing ids from whole documents.

    ``segments`` defaults to ``SEGMENTS``, or to twice as many pieces of the mean length as a sequence holds if that is
    more, so that a table of very short texts leaves no padding either.

    All ids of a piece but its first bear loss: nothing in the sequence comes before that one. ``loss`` defaults to
    ``window``, which binds for no document; instruction data with masked prompts goes to ``pack`` with its own counts.
    """
    from evenkeel.staging import stage

    pieces = stage(token_pieces(documents, window), "pieces")
    full = pieces.where(F.col("length") == window)
    alone = full.select(
        "*", (F.lit(FULL) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rests = pieces.where(F.col("length") < window).select(
        "*", F.lit(1).cast("long").alias("segments"), (F.col("length") - 1).alias("loss")
    )
    if segments is None:
        mean = rests.agg(F.avg("length")).first()[0] or window
        segments = max(SEGMENTS, math.ceil(2 * window / mean))
    limits = {"length": window, "segments": segments, "loss": loss or window}
    packed = pack(rests, limits, tokens="length", group_items=group_items).drop("segments", "loss")
    return alone.unionByName(packed)
