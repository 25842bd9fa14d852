"""A seeded permutation of row numbers: each row's place follows from its number alone."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.staging import stage

PRIME = (1 << 31) - 1
ROUNDS = 6
MOST_STEPS = 64


def _round_key(seed: int, turn: int, part: str) -> int:
    return int(hashlib.md5(f"{seed}:{turn}:{part}".encode()).hexdigest()[:15], 16) % PRIME


def place_of(number: Column, rows: int, seed: int) -> Column:
    """The place, from 0, of each ``number`` from 0 up to ``rows``: a bijection.

    A number is a pair of digits to the least base whose square is ``rows`` or more; rounds add a function of one digit to
    the other, each of which can be undone. A number outside goes through the rounds again until it is inside. There are
    at most twice as many outside as the base, so one step is mostly enough and ``MOST_STEPS`` have not been seen.
    """
    if rows > PRIME**2:
        raise ValueError(f"a table of {rows} rows is over {PRIME}^2")
    base = max(2, math.isqrt(max(0, rows - 1)) + 1)

    def mixed(value: Column) -> Column:
        low = F.pmod(value, F.lit(base).cast("long"))
        high = F.call_function("div", value, F.lit(base).cast("long"))
        for turn in range(ROUNDS):
            a, b, c = (F.lit(_round_key(seed, turn, part)).cast("long") for part in "abc")
            line = F.pmod(low * a + b, F.lit(PRIME).cast("long"))
            square = F.pmod(line * line + c, F.lit(PRIME).cast("long"))
            high, low = low, F.pmod(high + square, F.lit(base).cast("long"))
        return high * F.lit(base).cast("long") + low

    def ended(place: Column, otherwise: Column) -> Column:
        return F.when(place < F.lit(rows), place).otherwise(otherwise)

    # Lambdas are interpreted and nothing in them is shared, so only the few numbers outside get into one.
    first = mixed(number.cast("long"))
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(MOST_STEPS)),
        first,
        lambda v, _: ended(v, mixed(v)),
        lambda v: ended(v, F.raise_error(F.lit("the permutation did not end"))),
    )
    return ended(first, walked)


def numbered(df: DataFrame) -> tuple[DataFrame, int]:
    """``(number, item)`` and the number of rows: a written table, its rows numbered without gaps.

    The numbers are the places in the tasks that wrote the table, behind those of the tasks before; one count per task
    is all that is shuffled.
    """
    written = stage(df.select(F.monotonically_increasing_id().alias("at"), F.struct("*").alias("item")), "numbered")
    task, inside = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = written.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    bases = stage(counts.select("task", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "bases")
    rows = bases.agg(F.sum("n")).first()[0] or 0
    placed = written.withColumn("task", task).join(F.broadcast(bases), "task")
    return placed.select((F.col("before") + inside).alias("number"), "item"), rows


def permute_rows(df: DataFrame, seed: int, partitions: int | None = None) -> DataFrame:
    """Rows in random order, ``partitions`` even stretches of it, one to a partition.

    A row goes straight to the partition of its place; nothing is sampled and no range is cut. Repeated rows have
    numbers of their own, so they spread like any others; a re-run task finds the numbers written.
    """
    rows, count = numbered(df)
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = max(1, -(-count // parts))
    placed = rows.withColumn("place", place_of(F.col("number"), count, seed))
    part = F.floor(F.col("place") / F.lit(each)).cast("int").alias("part")
    return placed.select("item", "place", part).repartitionById(parts, F.col("part")).sortWithinPartitions("place").select(
        "item.*"
    )
