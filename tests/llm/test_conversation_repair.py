from __future__ import annotations

import hashlib
import random
from functools import cache

import pytest
from compare import assert_same, duck

from evenkeel.llm import conversation_repair as repair
from evenkeel.llm import queries
from evenkeel.llm.oracles import ORACLES

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(signature: str) -> tuple[int, str]:
    """The least cost and audit by trying every edit, with up to two insertions in a row."""

    @cache
    def best(at: int, state: str, put: int) -> tuple[int, str]:
        after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
        ways = []
        if at == len(signature) and state in ("", "a"):
            ways.append((0, ""))
        if put < 2:
            for role in "ua":
                if (state, role) in after:
                    cost, edits = best(at, after[state, role], put + 1)
                    ways.append((cost + 3, "I" + edits))
        if at < len(signature):
            sign = signature[at]
            cost, edits = best(at + 1, state, 0)
            ways.append((cost + 4, "D" + edits))
            if sign != "x":
                extra = 3 if sign.isupper() else 0
                for letter, more, role in [("K", 0, sign.lower()), ("R", 3, "u"), ("R", 3, "a")]:
                    if (state, role) in after:
                        cost, edits = best(at + 1, after[state, role], 0)
                        ways.append((cost + more + extra, letter + edits))
        return min(ways, default=(10**6, ""))

    return best(0, "", 0)


def test_endings_against_every_edit():
    draw = random.Random(3)
    words = sorted({"".join(draw.choices("suaoSUAOx", k=draw.randrange(0, 9))) for _ in range(2_000)})
    words.sort(key=lambda w: w[::-1])
    endings = repair.Endings()
    assert [endings.solve(w[::-1]) for w in words] == [plain(w) for w in words]
    assert endings.made == len({w[i:] for w in words for i in range(len(w))})


def test_whole_table(spark):
    assert assert_same(queries.op12_repair(spark, SF), duck(SF).sql(ORACLES["op12_repair"])) == 100


ROWS = [
    (1, 0, "system", "S."), (1, 1, "user", "Q?"), (1, 2, "assistant", "A!"),
    (2, None, "assistant", "first."), (2, 0, "user", " \t\x0b"), (2, 0, "user", "x"), (2, 5, "user", "x"), (2, 5, "user", "x"),
    (3, 1, None, "t."), (3, 1, "umbrella", "t. \n"), (3, 2, "", "t."), (3, 3, "ant", None),
    (None, None, None, None), (None, 4, "user", "nbsp "),
    *[(7, i, "user" if i % 2 == 0 else "assistant", "word " * (i * 50) + f"{i}.") for i in range(300)],
    *[(8, 3, "user", "again.")] * 500,
]


def by_hand(conv):
    """A conversation in one go, with nothing shared."""
    def same(r):
        role, text = r[2] or " " if r[2] is None else r[2], " " if r[3] is None else r[3]
        return role, text

    rows = [(r[1], *same(r)) for r in ROWS if r[0] == conv]
    rows.sort(key=lambda r: (
        r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    ))
    seen, signs, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not body:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        signs += {"": kind, "truncated": kind.upper()}.get(fault, "x")
    cost, audit = repair.Endings().solve(signs[::-1])
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    turns = {r[0] for r in rows if r[0] is not None}
    out, state, at = [], "", 0
    for letter in audit:
        if letter != "I":
            _, role, text = rows[at]
            at += 1
        if letter == "D":
            continue
        if letter != "K":
            role, text = ("assistant" if state == "u" else "user"), ("" if letter == "I" else text)
        state = role[0]
        out.append(f"{role}:{text}")
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **counts,
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


@pytest.mark.parametrize("slice_rows", [40, 50_000])
def test_edges(spark, monkeypatch, slice_rows):
    """Nulls, ties, repeated rows, blanks, long conversations over slices, keys without rows, clashing extra columns."""
    monkeypatch.setattr(repair.findings, "__defaults__", (*repair.findings.__defaults__[:-1], slice_rows))
    extra = ["_conv", "signature", "audit", "_same", "place", "copies", "slice", "is_turn", "cost"]
    rows = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", *[f"'e' as {c}" for c in extra])
    keys = spark.createDataFrame([(1,), (2,), (3,), (None,), (7,), (8,), (9,), (9,)], "conv_id long")
    found = {r["conv_id"]: r.asDict() for r in repair.report(keys, rows).collect()}
    assert set(found) == {1, 2, 3, None, 7, 8, 9}
    for conv in (1, 2, 3, None, 7, 8):
        assert found[conv] == {"conv_id": conv, **by_hand(conv)}, conv
    assert found[9]["repaired_sha256"] == hashlib.sha256().hexdigest()
    assert [found[9][c] for c in ("gaps", "blank", "cost", "audit")] == [0, 0, 0, ""]


def test_repaired_turns(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    audited = repair.audits(repair.findings(rows))
    turns = {}
    for r in repair.repaired_turns(rows, audited).orderBy("_conv", "place").collect():
        assert r["place"] == len(turns.setdefault(r["_conv"], []))
        turns[r["_conv"]].append(f"{r['role']}:{r['text']}")
    for conv in (1, 2, 7):
        lines = "\n".join(turns.get(str(conv), []))
        assert hashlib.sha256(lines.encode()).hexdigest() == by_hand(conv)["repaired_sha256"]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.report(none, repair.damaged(none)).collect() == []
