from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from compare import assert_same, duck

from evenkeel.llm import prefix_trie, queries
from evenkeel.llm.oracles import ORACLES

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def by_hand(rows):
    """Every prefix in a dictionary."""
    own: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in own.items()}
    nodes: dict[tuple, dict] = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        lender = conv - int(np.fmod(conv, 5))
        path = tuple(own.get(lender, [])[:h] + turns[h:])
        for depth in range(len(path) + 1):
            node = nodes.setdefault(path[:depth], {"members": [], "ends": []})
            node["members"].append(conv)
            if depth == len(path):
                node["ends"].append(conv)
    kids: dict[tuple, int] = {}
    for path in nodes:
        if path:
            kids[path[:-1]] = kids.get(path[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for path, node in nodes.items():
        worth = (len(node["members"]) - 1) * len(path[-1][1].encode()) if path else 0
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += path not in kids
            saved[path[:depth]] += worth
    told = [
        (
            min(n["members"]), len(p), min(nodes[p[:-1]]["members"]) if p else None, len(n["members"]), kids.get(p, 0),
            leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest(),
        )
        for p, n in nodes.items()
    ]
    return sorted(told, key=lambda r: (r[1], r[0]))


def found(df):
    assert tuple(df.columns) == NAMES
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r[0]))


def test_double_array():
    """Every sequence, and no other, is found by walking the arrays; each cell has one parent."""
    draw = random.Random(5)
    words = sorted({tuple(draw.choices(range(1, 9), k=draw.randrange(0, 7))) for _ in range(3_000)})
    lengths = np.array([len(w) for w in words])
    trie = prefix_trie.DoubleArray(np.array([t for w in words for t in w]), np.cumsum(lengths) - lengths, lengths)
    at = dict.fromkeys(words)
    for depth, rows, cells in trie.walk():
        for row, cell in zip(rows, cells, strict=True):
            assert at.setdefault(words[row][:depth], int(cell)) in (None, int(cell))
            at[words[row][:depth]] = int(cell)
    assert len(set(at.values())) == len(at) == (trie.check >= 0).sum()


def test_whole_table(spark):
    assert assert_same(queries.op11_trie(spark, SF), duck(SF).sql(ORACLES["op11_trie"])) > 200


def small_rows(seed, convs=120):
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(-20, 200), convs):
        for turn in range(draw.randrange(0, 12)):
            rows.append((conv, turn if draw.random() < 0.9 else None, draw.choice(["u", "a", None]), draw.choice(["", "x", "yy", "é", None])))
    rows += [(draw.choice(rows))[:1] + (3, "u", "x") for _ in range(20)]
    return rows


@pytest.mark.parametrize("shard_turns", [40, 10**6])
def test_against_every_prefix(spark, shard_turns):
    """Nulls, ties, repeated rows, absent lenders, negative keys, prefixes over many shards, extra columns."""
    rows = [*small_rows(1), (None, 0, "u", "x"), *[(1_000 + i, 0, "s", "the same start") for i in range(90)],
            *[(1_000 + i, 1, "u", f"then {i % 40}") for i in range(90)], *[(2_005, i, "u", f"long {i}") for i in range(400)]]
    extra = ["conv", "place", "said", "bytes", "turns", "upto", "times", "shard", "left", "path", "_name", "copies"]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"7 as {c}" for c in extra])
    turns, sizes = prefix_trie.rebuilt(prefix_trie.ordered_turns(df))
    nodes = prefix_trie.trie_nodes(prefix_trie.sequences(turns, sizes), shard_turns)
    assert found(nodes) == by_hand(rows)


def test_copies(spark):
    """A third of the conversations are one and the same; repeated rows are turns of their own."""
    rows = [(10 * i, t, "u", f"t{t}") for i in range(200) for t in range(3)] + [(10 * i + 5, t, "u", f"{i}-{t}") for i in range(300) for t in range(2)]
    rows += [(7, 1, "a", "again")] * 300
    assert found(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)


def test_empty_table(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA)).collect() == []
