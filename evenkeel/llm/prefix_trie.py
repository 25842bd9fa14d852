"""A prefix trie of conversations, packed shard by shard into double arrays.

A conversation is a sequence of turns, each told by a digest; equal sequences are one entry with its number of members.
The entries are ordered turn by turn and cut into shards, so a shard is a range of prefixes, no prefix can fill a shard
more than others, and only nodes on a shard's first or last path can have members in another shard.

A shard's turns get dense ids, and its trie is packed into two arrays: a child of node ``s`` by the turn ``t`` lies at
``BASE[s] + t``, and ``CHECK`` names its parent there. All entries are walked through the arrays at once, a depth at a
time, to count members; children, leaves and savings are added up along ``CHECK``. Nodes that several shards share are few,
a path per cut; what the shards know of them is merged at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import attach, shares
from evenkeel.operators.ordered import running_totals
from evenkeel.staging import stage

EVERY = 5
MOST_SHARED = 9
SHARD_TURNS = 200_000
ENDS_ROWS = 200_000
NO_ENDS = hashlib.sha256().hexdigest()
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, shared boolean, path binary, parent_path binary, last_bytes long"
)


def ordered_turns(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``(conv, place, turns, said, bytes)``: the turns numbered from 0, of ``turns`` in all; ``said`` is a digest of role and text.

    A null turn is first, a null role or text is empty, and turns that tie go by the digest. Equal rows are counted
    before they are ordered, and the order is cut into slices, so no conversation is in one task. Rows without a key
    belong to no conversation.
    """
    said_role, said_text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(said_role), F.lit(":"), said_role, said_text))).alias("said"),
        F.octet_length(said_text).cast("long").alias("bytes"),
    )
    counted = rows.groupBy("conv", "turn", "said", "bytes").agg(F.count(F.lit(1)).alias("times"))
    placed = running_totals(
        counted, order=[F.col("turn").asc_nulls_first(), "said"], totals={"upto": F.col("times")}, groups=["conv"]
    )
    first = F.col("upto") - F.col("times")
    return placed.select(
        "conv",
        F.explode(F.sequence(first, F.col("upto") - 1)).alias("place"),
        F.col("all_upto").alias("turns"),
        "said",
        "bytes",
    )


def rebuilt(turns: DataFrame, every: int = EVERY, most_shared: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """``(conv, place, said, bytes)`` and ``(conv, n)``: each conversation with its first turns taken from another one.

    Of conversation ``c`` the first ``h`` turns are those of ``c - c % every``, as far as it has them, ``h`` being the
    CRC-32 of ``c`` modulo ``most_shared``; its own turns follow after its first ``h``. ``n`` is how many it then has.
    """
    turns = stage(turns, "turns")
    heads = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most_shared))
    sizes = turns.groupBy("conv").agg(F.max("turns").alias("turns")).select(
        "conv", "turns", heads.alias("head"), (F.col("conv") - F.col("conv") % every).alias("_from")
    )
    sizes = stage(sizes, "sizes")
    lent = sizes.select(F.col("conv").alias("_from"), F.col("turns").alias("_lent"))
    plan = sizes.join(lent, "_from", "left").withColumn(
        "_taken", F.least(F.col("head"), F.coalesce("_lent", F.lit(0)))
    )
    plan = stage(plan, "rebuild")
    # At most a few heads follow each lender, and a head has a few turns.
    lenders = turns.where(F.col("place") < most_shared - 1).select(F.col("conv").alias("_from"), "place", "said", "bytes")
    heads = plan.select("conv", "_from", "_taken").join(lenders, "_from").where(F.col("place") < F.col("_taken"))
    own = attach(turns, plan.select("conv", "turns", "head", "_taken").withColumnRenamed("turns", "copies"), "conv", "copies", turns.count())
    tails = own.where(F.col("place") >= F.col("head")).select(
        "conv", (F.col("place") - F.col("head") + F.col("_taken")).alias("place"), "said", "bytes"
    )
    n = F.col("_taken") + F.greatest(F.col("turns") - F.col("head"), F.lit(0))
    return heads.select("conv", "place", "said", "bytes").unionByName(tails), plan.select("conv", n.alias("n"))


def sequences(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(said, bytes, n, least, members, ends)`` per distinct sequence: its turns in order, its members and a digest of
    their keys in ascending order, comma-joined.

    A conversation's digests and sizes, 24 bytes a turn, are one row; its text is not in it.
    """
    said = F.array_sort(F.collect_list(F.struct("place", "said", "bytes")))
    whole = turns.groupBy("conv").agg(said.alias("_turns"))
    empty = sizes.where(F.col("n") == 0).select("conv", F.lit(None).cast(whole.schema["_turns"].dataType).alias("_turns"))
    rows = whole.unionByName(empty).select(
        "conv",
        F.coalesce(F.col("_turns.said"), F.array().cast("array<binary>")).alias("said"),
        F.coalesce(F.col("_turns.bytes"), F.array().cast("array<long>")).alias("bytes"),
    )
    name = F.unhex(F.md5(F.concat_ws("", F.transform("said", F.hex))))
    rows = stage(rows.withColumn("_name", name), "sequences")
    entries = rows.groupBy("_name").agg(
        F.any_value("said").alias("said"),
        F.any_value("bytes").alias("bytes"),
        F.min("conv").alias("least"),
        F.count(F.lit(1)).alias("members"),
    )
    entries = stage(entries, "entries")
    lookup = entries.select("_name", F.col("members").alias("_copies"))
    several = lookup.where(F.col("_copies") > 1)
    repeated = attach(rows.select("_name", "conv"), several, "_name", "_copies", rows.count(), keep_copies=True)
    ends = member_digests(repeated.where(F.col("_copies").isNotNull()).select("_name", "conv"))
    alone = F.sha2(F.col("least").cast("string").cast("binary"), 256)
    return entries.join(ends, "_name", "left").select(
        "said", "bytes", "least", "members", F.coalesce("ends", alone).alias("ends")
    )


def member_digests(members: DataFrame) -> DataFrame:
    """``(_name, ends)`` for ``members (_name, conv)``: a digest that the keys pass through in order, one at a time."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sha, out = None, None, []
        for batch in batches:
            for name, conv in zip(batch.column("_name").to_pylist(), batch.column("conv").to_pylist(), strict=True):
                if name != current:
                    if current is not None:
                        out.append({"_name": current, "ends": sha.hexdigest()})
                    current, sha = name, hashlib.sha256(str(conv).encode())
                else:
                    sha.update(f",{conv}".encode())
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pylist(out, _ENDS)
                out = []
        if current is not None:
            out.append({"_name": current, "ends": sha.hexdigest()})
        if out:
            yield pa.RecordBatch.from_pylist(out, _ENDS)

    members = stage(members, "members")
    ordered = members.repartition(shares(members.count(), ENDS_ROWS), "_name").sortWithinPartitions("_name", "conv")
    return ordered.mapInArrow(digest, "_name binary, ends string")


_ENDS = pa.schema([("_name", pa.binary()), ("ends", pa.string())])


class DoubleArray:
    """The trie of sequences of dense ids, in order and distinct, packed into ``base`` and ``check``; the root is cell 0."""

    def __init__(self, labels: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        self.labels, self.starts, self.lengths = labels, starts, lengths
        self.base, self.check = np.zeros(1, dtype=np.int64), np.full(1, -1, dtype=np.int64)
        self.check[0] = 0  # the root is taken and its own parent
        self.free_from = 1
        cells = np.zeros(len(lengths), dtype=np.int64)
        for depth in range(int(lengths.max(initial=0))):
            longer = np.flatnonzero(lengths > depth)
            of, label = cells[longer], labels[starts[longer] + depth]
            # Sequences are in order, so those of a child lie side by side.
            new = np.r_[True, (of[1:] != of[:-1]) | (label[1:] != label[:-1])] if len(longer) else np.zeros(0, dtype=bool)
            self._add(of[new], label[new])
            cells[longer] = self.base[of] + label

    def _grow(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, 2 * len(self.base)) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])

    def _free(self, count: int) -> np.ndarray:
        """The first so many free cells."""
        while True:
            free = self.free_from + np.flatnonzero(self.check[self.free_from :] < 0)
            if len(free) >= count:
                return free[:count]
            self._grow(len(self.base) + count)

    def _add(self, parents: np.ndarray, labels: np.ndarray) -> None:
        """Cells for the children of the parents, which come in runs: widest runs first, only children where there is room."""
        first = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
        width = np.diff(np.r_[first, len(parents)])
        for i in np.flatnonzero(width > 1)[np.argsort(-width[width > 1], kind="stable")]:
            own = labels[first[i] : first[i] + width[i]]
            self._place(parents[first[i]], own)
        alone = first[width == 1]
        if len(alone):
            cells = self._free(len(alone))
            self.base[parents[alone]] = cells - labels[alone]
            self.check[cells] = parents[alone]
        while self.free_from < len(self.check) and self.check[self.free_from] >= 0:
            self.free_from += 1

    def _place(self, parent: int, labels: np.ndarray) -> None:
        """The first base from which all labels fall on free cells."""
        labels_from = labels - labels.min()
        tries = 32
        while True:
            for cell in self._free(tries):
                self._grow(int(cell + labels_from.max()) + 1)
                if (self.check[cell + labels_from] < 0).all():
                    self.base[parent] = cell - labels.min()
                    self.check[cell + labels_from] = parent
                    return
            tries *= 4

    def walk(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Depth by depth, the sequences that go so far and the cells they are at."""
        cells = np.zeros(len(self.lengths), dtype=np.int64)
        yield 0, np.arange(len(cells)), cells.copy()
        for depth in range(1, int(self.lengths.max(initial=0)) + 1):
            longer = np.flatnonzero(self.lengths >= depth)
            after = self.base[cells[longer]] + self.labels[self.starts[longer] + depth - 1]
            if not np.array_equal(self.check[after], cells[longer]):
                raise RuntimeError("a cell does not belong to its parent")
            cells[longer] = after
            yield depth, longer, after


def _path(turns: list[bytes]) -> list[bytes]:
    """A digest of each prefix, the empty one included."""
    out, sha = [hashlib.md5().digest()], hashlib.md5()
    for turn in turns:
        sha.update(turn)
        out.append(sha.digest())
    return out


def shard_nodes(shard: pa.Table) -> pa.Table:
    """The nodes of a shard's trie. Those on its first path down to depth ``left``, and on its last down to ``right``, may
    have members elsewhere; they have sums over the others below them only."""
    shard = shard.take(pa.array(sorted(range(shard.num_rows), key=shard.column("said").to_pylist().__getitem__)))
    said = shard.column("said").combine_chunks()
    lengths = np.diff(said.offsets.to_numpy().astype(np.int64))
    starts = np.cumsum(lengths) - lengths
    digests = said.flatten()
    coded = digests.dictionary_encode()
    trie = DoubleArray(coded.indices.to_numpy().astype(np.int64) + 1, starts, lengths)
    sizes = shard.column("bytes").combine_chunks().flatten().to_numpy()
    members, least = shard.column("members").to_numpy(), shard.column("least").to_numpy()
    ends = shard.column("ends").to_pylist()

    cells = len(trie.check)
    n_convs, depth_of, last = (np.zeros(cells, dtype=np.int64) for _ in range(3))
    smallest = np.full(cells, np.iinfo(np.int64).max)
    end_of = np.full(cells, -1, dtype=np.int64)
    shared, paths = np.zeros(cells, dtype=bool), {}
    lefts, rights = int(shard.column("left")[0].as_py()), int(shard.column("right")[0].as_py())
    edge = {0: (lefts, _path(said[0].as_py()[:lefts])), len(lengths) - 1: (rights, _path(said[len(lengths) - 1].as_py()[:rights]))}
    if len(lengths) == 1:
        edge[0] = max((lefts, _path(said[0].as_py()[:lefts])), edge[0], key=lambda e: e[0])
    levels = []
    for depth, rows, at in trie.walk():
        np.add.at(n_convs, at, members[rows])
        np.minimum.at(smallest, at, least[rows])
        if depth:
            last[at] = sizes[starts[rows] + depth - 1]
        depth_of[at] = depth
        done = lengths[rows] == depth
        end_of[at[done]] = rows[done]
        levels.append(np.unique(at))
        for row, (deepest, path) in edge.items():
            if depth <= deepest and depth <= lengths[row]:
                cell = int(at[np.searchsorted(rows, row)])
                shared[cell], paths[cell] = True, path[: depth + 1]

    parent = trie.check
    taken = np.concatenate(levels)
    below = taken[taken != 0]
    children, leaves, saved = (np.zeros(cells, dtype=np.int64) for _ in range(3))
    np.add.at(children, parent[below[~shared[below]]], 1)
    own = taken[~shared[taken]]
    leaves[own] = children[own] == 0
    saved[own] = (n_convs[own] - 1) * last[own]
    for level in levels[:0:-1]:
        # A shared node's own part is known after the merge; it hands nothing on.
        inner = level[~shared[level]]
        np.add.at(leaves, parent[inner], leaves[inner])
        np.add.at(saved, parent[inner], saved[inner])
    is_open = shared[parent[taken]] & (taken != 0)
    none = pa.scalar(None, pa.int64())
    upper = pa.array(smallest[parent[taken]])
    return pa.table({
        "conv_id": smallest[taken],
        "depth": depth_of[taken],
        "parent_conv_id": pc.if_else(pa.array(is_open | (taken == 0)), none, upper),
        "n_convs": n_convs[taken],
        "n_children": children[taken],
        "n_leaves": leaves[taken],
        "saved_tokens": saved[taken],
        "ends_sha256": pa.array([ends[i] if i >= 0 else None for i in end_of[taken]], pa.string()),
        "shared": shared[taken],
        "path": pa.array([paths[c][-1] if c in paths else None for c in taken.tolist()], pa.binary()),
        "parent_path": pa.array(
            [_parent_path(paths, int(parent[c])) if o else None for c, o in zip(taken.tolist(), is_open, strict=True)],
            pa.binary(),
        ),
        "last_bytes": last[taken],
    })


def _parent_path(paths: dict[int, list[bytes]], parent: int) -> bytes:
    return paths[parent][-1]


def merge_shared(parts: pa.Table) -> pa.Table:
    """Shared nodes once each: members and sums over all shards, and over the shared nodes below them."""
    nodes: dict[bytes, dict] = {}
    for row in parts.to_pylist():
        node = nodes.setdefault(row["path"], row | {"n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0, "ends_sha256": None})
        for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
            node[c] += row[c]
        node["conv_id"] = min(node["conv_id"], row["conv_id"])
        node["ends_sha256"] = node["ends_sha256"] or row["ends_sha256"]
    deepest_first = sorted(nodes.values(), key=lambda n: -n["depth"])
    for node in deepest_first:
        if node["depth"]:
            nodes[node["parent_path"]]["n_children"] += 1
    for node in deepest_first:
        node["n_leaves"] += node["n_children"] == 0
        if node["depth"]:
            node["saved_tokens"] += (node["n_convs"] - 1) * node["last_bytes"]
            upper = nodes[node["parent_path"]]
            upper["n_leaves"] += node["n_leaves"]
            upper["saved_tokens"] += node["saved_tokens"]
            node["parent_conv_id"] = upper["conv_id"]
    return pa.Table.from_pylist(list(nodes.values()), parts.schema)


def trie_nodes(entries: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie's nodes for ``entries`` as of ``sequences``: ``(conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256)``. No entries give no node, not even a root."""
    entries = stage(entries, "trie")
    turns = entries.agg(F.sum(F.size("said") + 1)).first()[0] or 0
    sharded = stage(
        entries.repartitionByRange(shares(turns, shard_turns), "said").withColumn("shard", F.spark_partition_id()), "shards"
    )
    # How deep the paths to either side of a cut are the same: one row per shard.
    edges = sharded.groupBy("shard").agg(F.min("said").alias("first"), F.max("said").alias("last"))
    beside = Window.orderBy("shard")
    cuts = edges.select("shard", "first", "last", F.lag("last").over(beside).alias("before"), F.lead("first").over(beside).alias("after"))

    def together(a: str, b: str):
        same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
        return F.coalesce(F.array_position(same, False) - 1, F.lit(0)).cast("int")

    cuts = stage(cuts.select("shard", together("first", "before").alias("left"), together("last", "after").alias("right")), "cuts")
    count = cuts.count()
    found = sharded.join(cuts, "shard").repartition(max(1, count), "shard").groupBy("shard").applyInArrow(shard_nodes, NODES)
    found = stage(found, "nodes")
    # Two paths per shard at most, down to where the cut parts them.
    shared = stage(
        found.where("shared").withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(_merged, NODES), "shared"
    )
    names = shared.select(F.col("path").alias("_of"), F.col("n_children").alias("_children"), F.col("conv_id").alias("_parent"))
    inner = found.where("not shared")
    below = attach(
        inner.where(F.col("parent_path").isNotNull()).withColumn("_of", F.col("parent_path")), names, "_of", "_children", inner.count()
    ).withColumn("parent_conv_id", F.col("_parent")).select(*found.columns)
    nodes = inner.where(F.col("parent_path").isNull()).unionByName(below).unionByName(shared)
    return nodes.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def _merged(parts: pa.Table) -> pa.Table:
    return merge_shared(parts.drop_columns(["_all"]))


def conversation_trie(
    conversations: DataFrame,
    every: int = EVERY,
    most_shared: int = MOST_SHARED,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node.

    Nulls count as empty texts, a null turn is first, ties go by a digest, repeated rows are turns of their own, and rows
    without a key are left out. Other columns are left out, whatever their names. An empty table has no node.
    """
    turns, sizes = rebuilt(ordered_turns(conversations, key, turn, role, text), every, most_shared)
    return trie_nodes(sequences(turns, sizes))
