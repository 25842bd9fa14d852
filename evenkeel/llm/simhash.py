"""SimHash near-duplicates, found with vantage-point trees.

A document's fingerprint has a bit set where over half of its shingles' hashes have it. Two fingerprints link at few
differing bits; this distance is a metric, so a tree of vantage points can tell by the triangle inequality which parts
can hold a partner.

The upper levels of the tree are fitted on a bounded sample and cut the distinct fingerprints into shards. Each
fingerprint is a member of one shard; it also visits every shard that its ball overlaps, one way only, so each pair is
met once and none is missed. Inside a shard the tree goes on down to leaves that are compared outright. A shard hands on
a spanning forest of its links, never its pairs, and the components are joined up in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import attach, by_group, identified, shares
from evenkeel.llm.components import component_roots
from evenkeel.staging import stage

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SHARD_CODES = 10_000
SAMPLE = 20_000
MAX_LEVELS = 12
LEAF = 384
PAIRS_AT_ONCE = 1 << 18

_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_BYTE_PLACE = (np.arange(8) * 256).astype(np.int64)


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a whole text: A-Z lower-cased, words split at ASCII white space, repeats counted."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        columns = [words[i : len(words) - shingle + 1 + i] for i in range(shingle)]
        hashes = [digest(b" ".join(some), SEED) for some in zip(*columns, strict=True)]
    as_bytes = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((as_bytes + _BYTE_PLACE).ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    return int(np.packbits(2 * counts.ravel() > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    documents: DataFrame,
    shingle: int = SHINGLE,
    key: str | None = "doc_id",
    text: str = "text",
    place: Sequence[str] = (),
) -> DataFrame:
    """``(doc_id, code)``, the code as a signed long, or the columns ``place`` (binary and long) instead of the key. One
    scan; null texts count as empty."""
    names, kinds = (["doc_id"], ["long"]) if key else (list(place), ["binary", "long"])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([fingerprint_of(t.as_py(), shingle) for t in batch.column("text")], dtype=np.uint64)
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(codes.view(np.int64))], [*names, "code"])

    own = [F.col(key).cast("long").alias("doc_id")] if key else list(place)
    schema = ", ".join(f"{n} {k}" for n, k in zip([*names, "code"], [*kinds, "long"], strict=True))
    return documents.select(*own, F.col(text).alias("text")).mapInArrow(of_batches, schema)


def distances(codes: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(codes ^ point).astype(np.int16)


def choose_point(codes: np.ndarray) -> tuple[np.uint64, int] | None:
    """Of some evenly spaced codes, the one whose distances spread most, and their median.

    None if no distance tells the codes apart.
    """
    best = None
    for candidate in codes[np.linspace(0, len(codes) - 1, 8).astype(int)]:
        d = distances(codes[:: max(1, len(codes) // 512)], candidate)
        if best is None or d.std() > best[0]:
            best = (d.std(), candidate)
    d = distances(codes, best[1])
    cut = int(np.median(d))
    if (d <= cut).all():
        cut = int(d.max()) - 1
    return (best[1], cut) if 0 <= cut and (d <= cut).any() else None


def fit_tree(sample: np.ndarray, levels: int) -> list[tuple[int, int]]:
    """Vantage points and cuts of the upper levels, the children of ``i`` at ``2i + 1`` and ``2i + 2``."""
    nodes: list[tuple[int, int]] = []
    parts = [np.sort(sample)]
    for i in range((1 << levels) - 1):
        codes = parts[i]
        found = choose_point(codes) if len(codes) > 1 else None
        point, cut = found if found else (np.uint64(0), 32)
        nodes.append((int(point), cut))
        near = distances(codes, point) <= cut
        parts += [codes[near], codes[~near]]
    return nodes


def route(codes: np.ndarray, nodes: list[tuple[int, int]], radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard, row and whether the row is at home there, for every shard that a row's ball overlaps one way."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    todo = [(0, np.arange(len(codes)), np.ones(len(codes), dtype=bool))]
    while todo:
        node, rows, home = todo.pop()
        if node >= len(nodes):
            out.append((np.full(len(rows), node - len(nodes), dtype=np.int32), rows, home))
            continue
        point, cut = nodes[node]
        d = distances(codes[rows], np.uint64(point))
        near, far = np.where(home, d <= cut, d - radius <= cut), d + radius > cut
        todo.append((2 * node + 1, rows[near], home[near]))
        todo.append((2 * node + 2, rows[far], home[far] & (d[far] > cut)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Forest:
    """Union of links in place; labels are the smallest row of a tree."""

    def __init__(self, size: int) -> None:
        self.labels = np.arange(size)
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.pending.append((a, b))
            self.waiting += len(a)
            if self.waiting > PAIRS_AT_ONCE:
                self.flush()

    def flush(self) -> np.ndarray:
        if self.pending:
            a, b = (np.concatenate(x) for x in zip(*self.pending, strict=True))
            self.pending, self.waiting = [], 0
            while True:
                left, right = self.labels[a], self.labels[b]
                apart = left != right
                if not apart.any():
                    break
                a, b, left, right = a[apart], b[apart], left[apart], right[apart]
                np.minimum.at(self.labels, np.maximum(left, right), np.minimum(left, right))
                while not np.array_equal(jumped := self.labels[self.labels], self.labels):
                    self.labels = jumped
        return self.labels


def link_shard(codes: np.ndarray, home: np.ndarray, radius: int) -> np.ndarray:
    """Labels of a forest that spans the links between members, and between visitors and members."""
    forest = Forest(len(codes))

    def compare(members: np.ndarray, others: np.ndarray, same: bool) -> None:
        step = max(1, PAIRS_AT_ONCE // max(1, len(members)))
        for at in range(0, len(others), step):
            some = others[at : at + step]
            close = np.bitwise_count(codes[some][:, None] ^ codes[members][None, :]) <= radius
            if same:
                close &= some[:, None] < members[None, :]
            i, j = np.nonzero(close)
            forest.add(some[i], members[j])

    todo = [(np.flatnonzero(home), np.flatnonzero(~home))]
    while todo:
        members, visitors = todo.pop()
        found = choose_point(codes[members]) if len(members) > LEAF else None
        if found is None:
            compare(members, members, same=True)
            compare(members, visitors, same=False)
            continue
        point, cut = found
        d, dv = distances(codes[members], point), distances(codes[visitors], point)
        near = d <= cut
        todo.append((members[near], visitors[dv - radius <= cut]))
        todo.append((members[~near], np.concatenate([visitors[dv + radius > cut], members[near & (d + radius > cut)]])))
    return forest.flush()


def links(
    codes: DataFrame, max_bits: int = MAX_BITS, shard_codes: int = SHARD_CODES, sample: int = SAMPLE
) -> DataFrame:
    """``(a, b)``: a spanning forest of the links between the distinct codes of ``codes (code)``."""
    count = codes.count()
    levels = min(MAX_LEVELS, (shares(count, shard_codes) - 1).bit_length())
    every = max(1, count // sample)
    picked = codes.where(F.pmod(F.xxhash64("code"), F.lit(every)) == 0).select("code").limit(
        2 * sample
    ) if levels else None
    nodes = fit_tree(
        np.array([r[0] for r in picked.collect()], dtype=np.int64).view(np.uint64), levels
    ) if levels else []

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            shard, row, home = route(own.view(np.uint64), nodes, max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array(own[row]), pa.array(home)], ["shard", "code", "home"]
            )

    def link(group: pa.Table) -> pa.Table:
        own = group.column("code").to_numpy().astype(np.int64)
        home = group.column("home").to_numpy(zero_copy_only=False)
        order = np.lexsort((own, ~home))
        own, home = own[order], home[order]
        labels = link_shard(own.view(np.uint64), home, max_bits)
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.table({"a": own[linked], "b": own[labels[linked]]})

    dealt_codes = codes.select("code").mapInArrow(deal, "shard int, code long, home boolean")
    return by_group(dealt_codes, 1 << levels, "shard").groupBy("shard").applyInArrow(link, "a long, b long")


def near_duplicates(
    documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per document; the component is named by its smallest key.

    Null and empty texts, and texts without words, have fingerprint zero and link like any other. Repeated rows stay.
    Null keys name no component unless it has no other. An empty table gives an empty result.
    """
    rows = stage(fingerprints(documents, shingle, key, text), "fingerprints")
    named = components(rows, max_bits, "doc_id", ["doc_id"])
    return named.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def components(rows: DataFrame, max_bits: int, name: str, kept: Sequence[str]) -> DataFrame:
    """``kept``, ``code`` and ``component_id``, the smallest ``name`` (a long) reachable, for a written table of codes."""
    distinct = stage(
        rows.groupBy("code").agg(F.min(name).alias("least"), F.count(F.lit(1)).alias("copies")), "codes"
    )
    roots = stage(component_roots(links(distinct, max_bits)), "roots")
    rooted = distinct.join(roots.withColumnRenamed("node", "code"), "code", "left").withColumn(
        "root", F.coalesce("root", "code")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    lookup = rooted.join(names, "root").select("code", "copies", "component_id")
    found = attach(rows, stage(lookup, "components"), "code", "copies", rows.count())
    return found.select(*kept, "code", "component_id")


def distinct_documents(
    documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each group of near duplicates, in all its columns: the one with the smallest key, nulls last.

    Null and empty texts are near duplicates of each other. Of rows that tie for the smallest key any one stays. Columns
    may have any names. An empty table stays empty. Documents are told by their place in their files, which no re-run and
    no change of executors between two scans alters; their numbers are written once.
    """
    rows = identified(documents)
    place = ["file", "at"]
    narrow = stage(
        fingerprints(rows.select(*place, F.col("item")[text].alias("text")), shingle, None, "text", place).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "fingerprints",
    )
    groups = components(narrow, max_bits, "row", ["row", *place])
    keyed = stage(groups.join(rows.select(*place, F.col("item")[key].alias("key")), place), "groups")
    first = keyed.groupBy("component_id").agg(
        F.min_by("row", F.struct(F.col("key").isNull(), "key", "row")).alias("row")
    )
    others = keyed.join(first.select("row"), "row", "left_anti").select(*place)
    return rows.join(others, place, "left_anti").select("item.*")
