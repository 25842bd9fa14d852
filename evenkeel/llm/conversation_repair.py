"""Repair of conversations with one automaton for all of them, shared from the end.

What a repair may do follows from a conversation's signature alone: a sign per turn for its role's initial and its fault.
The distinct signatures are read from their ends and ordered so; conversations with equal ends then lie side by side, and
the path of the one before is kept for as far as the next shares it. So a node of the automaton, which stands for all
signatures with one ending, is worked out once: for each state of the grammar the least cost from there to the end, and
the best edits as the edits at this node and the state in which the next one takes over.

The grammar of role initials is ``(s?(ua)+)?``. From each of its states a turn can be kept, reroled, deleted or preceded by
an insertion in one way at most, so equal costs are settled by the letter of the edit.

Signatures are put together from slices of the ordered turns, so a conversation of any length is worked on by many tasks;
a byte a turn is the most that is gathered of it. Only its repaired text, which one digest reads in order, is one stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import attach, shares
from evenkeel.staging import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SLICE_ROWS = 50_000
SIGNATURES = 50_000
STREAM_ROWS = 20_000

#: States of the grammar: nothing yet, after s, after u, after a; and where a role's initial leads.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {
    (NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
#: The one role that may be put in a state, by insertion or a new role.
PUT = {NOTHING: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLES = {"u": "user", "a": "assistant"}
#: At the end of a conversation: the cost and the edits in each state.
END = ((0, 2 * INSERT, INSERT, 0), ("", "II", "I", ""))

BLANKS = " \t\n\x0b\x0c\r"
FRAGMENT = (
    "_conv string, slice int, signature string, first_initial string, last_initial string, illegal long, turns long, "
    "first_turn long, last_turn long, least long, most long, blank long, duplicate long, truncated long"
)


@cache
def node(sign: str, costs: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    """A node's least costs by state, and by state the edits up to and including its turn and the state after it.

    ``costs`` are those of the node that follows. Signs: ``x`` must be deleted; others are the role's initial, ``o`` for
    none of the grammar's, in upper case if the turn is cut off.
    """
    role, extra = sign.lower(), TRUNCATED if sign.isupper() else 0
    best = []
    for state in range(4):
        ways = [(DELETE + costs[state], "D", state)]
        if sign != "x":
            put = AFTER[state, PUT[state]]
            ways.append((REROLE + extra + costs[put], "R", put))
            if (state, role) in AFTER:
                ways.append((KEEP + extra + costs[AFTER[state, role]], "K", AFTER[state, role]))
        best.append(min(ways))
    # An insertion leads to another state of the same node; two in a row lead nowhere new, so once around is enough.
    out = list(best)
    for state in (USER, ASSISTANT, NOTHING, SYSTEM):
        to = AFTER[state, PUT[state]]
        cost, edits, after = best[to] if state in (USER, ASSISTANT) else out[to]
        out[state] = min(best[state], (INSERT + cost, "I" + edits, after))
    return tuple(w[0] for w in out), tuple((w[1], w[2]) for w in out)


class Endings:
    """The automaton's nodes on the path of the last signature, from its end. Costs are kept relative to their least."""

    def __init__(self) -> None:
        self.path: list[str] = []
        self.nodes: list[tuple[int, tuple[int, ...], tuple[tuple[str, int], ...]]] = []
        self.made = 0

    def solve(self, backwards: str) -> tuple[int, str]:
        """The least cost and the first in order of the cheapest edits of a signature given from its end."""
        shared = 0
        for mine, other in zip(self.path, backwards):
            if mine != other:
                break
            shared += 1
        del self.nodes[shared:], self.path[shared:]
        base, costs = self.nodes[-1][:2] if self.nodes else (0, END[0])
        for sign in backwards[shared:]:
            costs, moves = node(sign, costs)
            least = min(costs)
            base, costs = base + least, tuple(c - least for c in costs)
            self.nodes.append((base, costs, moves))
            self.path.append(sign)
            self.made += 1
        state, edits = NOTHING, []
        for _, _, moves in reversed(self.nodes):
            letters, state = moves[state]
            edits.append(letters)
        edits.append(END[1][state])
        return base + costs[NOTHING], "".join(edits)


def solved(signatures: DataFrame, per_task: int = SIGNATURES) -> DataFrame:
    """``signatures (signature, copies)``, distinct, with ``cost``, ``audit`` and the ``nodes`` made for it: those for
    endings that no signature before it in the slice has."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings = Endings()
        for batch in batches:
            found, nodes = [], []
            for backwards in batch.column("_backwards").to_pylist():
                before = endings.made
                found.append(endings.solve(backwards))
                nodes.append(endings.made - before)
            costs, audits = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("signature"), batch.column("copies"), *map(pa.array, (
                    pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(nodes, pa.int64())
                ))],
                ["signature", "copies", "cost", "audit", "nodes"],
            )

    count = signatures.count()
    ordered = signatures.select("signature", "copies", F.reverse("signature").alias("_backwards"))
    ordered = ordered.repartitionByRange(shares(count, per_task), "_backwards").sortWithinPartitions("_backwards")
    return ordered.mapInArrow(solve, "signature string, copies long, cost long, audit string, nodes long")


def _turns(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``(_conv, turn, role, text, _same)`` without nulls but in ``turn``; ``_same`` tells equal role and text."""
    filled = rows.select(
        conversation(key).alias("_conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    same = F.unhex(F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text")))
    return filled.withColumn("_same", same)


def conversation(key: str) -> Column:
    """The conversation's key as text; a null key is one space."""
    return F.coalesce(F.col(key).cast("string"), F.lit(" "))


def _order() -> list:
    return ["_conv", F.col("turn").asc_nulls_first(), "role", "_same"]


def _entries(turns: DataFrame) -> DataFrame:
    """Equal turns of a conversation as one entry with their number, and the first turn that has its role and text."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    facts = turns.select(
        "_conv",
        "turn",
        "role",
        "_same",
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    entries = stage(
        facts.groupBy("_conv", "turn", "role", "_same")
        .agg(
            F.first("blank").alias("blank"), F.first("truncated").alias("truncated"), F.count(F.lit(1)).alias("times")
        )
        .select(
            "_conv",
            "turn",
            "role",
            F.substring("role", 1, 1).alias("initial"),
            "_same",
            "blank",
            "truncated",
            "times",
            F.unhex(F.md5(F.concat(F.hex("_same"), "_conv"))).alias("_said"),
        ),
        "turns",
    )
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = entries.groupBy("_said").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_copies"))
    again = stage(again.where(F.col("_copies") > 1), "repeated")
    marked = attach(entries, again, "_said", "_copies", entries.count())
    later = F.coalesce(place > F.col("_first"), F.lit(False))
    return marked.withColumn("duplicate", later).drop("_said", "_first")


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a slice of the ordered entries has of each conversation."""
    slice_, current, out = TaskContext.get().partitionId(), None, []

    def close() -> None:
        if current is not None:
            signs = b"".join(current["signs"]).decode()
            out.append({k: v for k, v in current.items() if k != "signs"} | {"signature": signs})

    for batch in batches:
        columns = ("_conv", "turn", "initial", "blank", "truncated", "duplicate", "times")
        for conv, turn, initial, blank, truncated, duplicate, times in zip(
            *(batch.column(c).to_pylist() for c in columns), strict=True
        ):
            if current is None or current["_conv"] != conv:
                close()
                current = {
                    "_conv": conv, "slice": slice_, "first_initial": initial, "last_initial": None, "illegal": 0,
                    "turns": 0, "first_turn": turn, "last_turn": None, "least": None, "most": None,
                    "blank": 0, "duplicate": 0, "truncated": 0, "signs": [],
                }
            if current["last_initial"] is not None:
                current["illegal"] += current["last_initial"] + initial not in LEGAL
            current["illegal"] += (times - 1) * (initial + initial not in LEGAL)
            current["last_initial"] = initial
            if turn is not None:
                current["turns"] += turn != current["last_turn"]
                current["least"] = turn if current["least"] is None else current["least"]
                current["most"] = turn
            current["last_turn"] = turn
            if blank:
                current["blank"] += times
                sign, rest = b"x", b"x" * (times - 1)
            else:
                repeated = times if duplicate else times - 1
                current["duplicate"] += repeated
                current["truncated"] += truncated and not duplicate
                kind = initial if initial in ("s", "u", "a") else "o"
                sign = b"x" if duplicate else (kind.upper() if truncated else kind).encode()
                rest = b"x" * (times - 1)
            current["signs"] += [sign, rest]
        if out:
            yield pa.RecordBatch.from_pylist(out, _FRAGMENT)
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_pylist(out, _FRAGMENT)


LEGAL = ("su", "ua", "au")
_FRAGMENT = pa.schema([
    (n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[t]) for n, t in map(str.split, FRAGMENT.split(", "))
])


def findings(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``(_conv, gaps, blank, duplicate, truncated, illegal, signature)`` per conversation with rows."""
    entries = stage(_entries(_turns(rows, key, turn, role, text)), "entries")
    ordered = entries.repartitionByRange(shares(entries.count(), slice_rows), *_order()).sortWithinPartitions(*_order())
    parts = stage(ordered.mapInArrow(_fragments, FRAGMENT), "fragments")
    before = Window.partitionBy("_conv").orderBy("slice")  # a row per slice that has some of the conversation
    joint = F.concat(F.lag("last_initial").over(before), "first_initial")
    joined = parts.withColumns({
        "_joint": F.coalesce((~joint.isin(*LEGAL)).cast("long"), F.lit(0)),
        "_again": F.coalesce((F.lag("last_turn").over(before) == F.col("first_turn")).cast("long"), F.lit(0)),
    })
    signs = F.transform(F.array_sort(F.collect_list(F.struct("slice", "signature"))), lambda p: p["signature"])
    merged = joined.groupBy("_conv").agg(
        (F.max("most") - F.min("least") + 1 - F.sum(F.col("turns") - F.col("_again"))).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + F.col("_joint")).alias("illegal"),
        F.array_join(signs, "").alias("signature"),
    )
    return merged.withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))


def audits(found: DataFrame) -> DataFrame:
    """``findings`` with ``cost`` and ``audit``: the edits of a cheapest repair by their initials (Keep, Rerole, Delete,
    Insert), the first in order of such."""
    found = stage(found, "findings")
    signatures = stage(found.groupBy("signature").agg(F.count(F.lit(1)).alias("copies")), "signatures")
    edits = stage(solved(signatures).drop("nodes"), "edits")
    return attach(found, edits, "signature", "copies", found.count())


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[str, str]] | None]]:
    """Repaired turns in order, ``(conversation, [(role, text), ...])``, and ``(conversation, None)`` at its end.

    A conversation's first row has its audit in ``text``. Of the turns, one at a time is looked at.
    """
    conv, audit, at, state = None, "", 0, NOTHING

    def put() -> tuple[str, str]:
        nonlocal state
        role = PUT[state]
        state = AFTER[state, role]
        return ROLES[role], ""

    def inserted() -> list[tuple[str, str]]:
        nonlocal at
        out = []
        while at < len(audit) and audit[at] == "I":
            out.append(put())
            at += 1
        return out

    for batch in batches:
        for of, is_turn, role, text in zip(
            *(batch.column(c).to_pylist() for c in ("_conv", "is_turn", "role", "text")), strict=True
        ):
            if not is_turn:
                if conv is not None:
                    yield conv, inserted()
                    yield conv, None
                conv, audit, at, state = of, text, 0, NOTHING
                continue
            out = inserted()
            letter = audit[at]
            at += 1
            if letter == "K":
                state = AFTER[state, role[:1]]
                out.append((role, text))
            elif letter == "R":
                out.append((put()[0], text))
            yield of, out
    if conv is not None:
        yield conv, inserted()
        yield conv, None


def _beside_audits(rows: DataFrame, audited: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """The audits and the turns they are about, each conversation's in order in one partition."""
    turns = _turns(rows, key, turn, role, text).withColumn("is_turn", F.lit(True))
    heads = audited.select("_conv", F.col("audit").alias("text"), F.lit(False).alias("is_turn"))
    both = heads.unionByName(turns, allowMissingColumns=True)
    order = ["_conv", "is_turn", *_order()[1:]]
    return both.repartition(shares(rows.count(), STREAM_ROWS), "_conv").sortWithinPartitions(*order)


def repaired_turns(
    rows: DataFrame, audited: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``(_conv, place, role, text)``: the repaired conversations, turns numbered from 0."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, out = 0, []
        for conv, turns in _edited(batches):
            if turns is None:
                place = 0
                continue
            for said in turns:
                out.append((conv, place, *said))
                place += 1
            if len(out) >= 1_000:
                yield _as_batch(out, "_conv place role text", (pa.string(), pa.int64(), pa.string(), pa.string()))
                out = []
        if out:
            yield _as_batch(out, "_conv place role text", (pa.string(), pa.int64(), pa.string(), pa.string()))

    return _beside_audits(rows, audited, key, turn, role, text).mapInArrow(
        apply, "_conv string, place long, role string, text string"
    )


def repaired_digests(
    rows: DataFrame, audited: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``(_conv, repaired_sha256)``: the digest of the repaired ``role:text`` lines.

    A conversation's text goes through its digest in order, so through one task, a turn at a time.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, lines, out = hashlib.sha256(), 0, []
        for conv, turns in _edited(batches):
            if turns is None:
                out.append((conv, sha.hexdigest()))
                sha, lines = hashlib.sha256(), 0
                if len(out) >= 10_000:
                    yield _as_batch(out, "_conv repaired_sha256", (pa.string(), pa.string()))
                    out = []
                continue
            for role_, text_ in turns:
                sha.update(f"{chr(10) if lines else ''}{role_}:{text_}".encode())
                lines += 1
        if out:
            yield _as_batch(out, "_conv repaired_sha256", (pa.string(), pa.string()))

    return _beside_audits(rows, audited, key, turn, role, text).mapInArrow(digest, "_conv string, repaired_sha256 string")


def _as_batch(rows: list[tuple], names: str, types: tuple[pa.DataType, ...]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names.split())


def report(
    conversations: DataFrame,
    rows: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per key of ``conversations``, with what is found in its ``rows`` and how they are repaired.

    Nulls count as one space, a null turn comes before all others, and turns that tie go by role and a digest of the text.
    Equal rows stay. A key without rows has zeros, an empty audit and the digest of nothing. Other columns are left out,
    whatever their names; an empty table gives an empty result.
    """
    columns = (key, turn, role, text)
    audited = stage(audits(findings(rows, *columns)), "audits")
    digests = repaired_digests(rows, audited, *columns)
    keys = conversations.select(F.col(key).alias("conv_id"), conversation(key).alias("_conv")).distinct()
    known = keys.join(audited, "_conv", "left").join(digests, "_conv", "left")
    zero = F.lit(0).cast("long")
    return known.select(
        "conv_id",
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def damaged(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``(conv_id, turn, role, text)`` with one row in twenty each dropped, emptied, stripped of its full stops, repeated
    or said by the user, by a checksum of key and turn. Nulls but those of key and turn become one space."""
    filled = conversations.select(
        F.col(key).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
        F.concat_ws(
            ":", conversation(key), F.coalesce(F.col(turn).cast("string"), F.lit(" "))
        ).alias("_name"),
    ).withColumn("_fault", F.pmod(F.crc32(F.col("_name").cast("binary")), F.lit(20)))
    changed = filled.where(F.col("_fault") != 0).select(
        "conv_id",
        "turn",
        F.when(F.col("_fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_fault") == 1, F.lit(""))
        .when(F.col("_fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("_fault") == 3, 2).otherwise(1).alias("_times"),
    )
    return changed.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(1), F.col("_times")))).drop(
        "col"
    )
