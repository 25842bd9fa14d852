from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import permutation


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 17, 100, 1_000, 4_097])
def test_places_are_a_permutation(spark, rows):
    places = [
        r["p"] for r in spark.range(rows).select(permutation.place_of(F.col("id"), rows, 42).alias("p")).collect()
    ]
    assert sorted(places) == list(range(rows))
    if rows >= 100:
        fixed = sum(p == i for i, p in enumerate(places))
        ups = sum(a < b for a, b in zip(places, places[1:]))
        assert fixed < 8 and abs(ups - rows / 2) < 4 * rows**0.5
        other = [r["p"] for r in spark.range(rows).select(permutation.place_of(F.col("id"), rows, 43).alias("p")).collect()]
        assert other != places


def test_numbers_inside_at_once_do_not_walk(spark, monkeypatch):
    """All numbers below a square are inside after the first step; the walk is interpreted and costs 0.2 ms a row."""
    monkeypatch.setattr(permutation.F, "aggregate", lambda *_: F.raise_error(F.lit("walked")))
    places = spark.range(10_000).select(permutation.place_of(F.col("id"), 10_000, 42).alias("p")).collect()
    assert sorted(r["p"] for r in places) == list(range(10_000))
    with pytest.raises(Exception, match="walked"):
        spark.range(9_950).select(permutation.place_of(F.col("id"), 9_950, 42).alias("p")).collect()


@pytest.mark.parametrize("rows", [2, 5, 150, 9_950])
def test_places_follow_whole_number_arithmetic(spark, rows):
    base = max(2, math.isqrt(rows - 1) + 1)

    def mixed(value):
        high, low = value // base, value % base
        for turn in range(permutation.ROUNDS):
            a, b, c = (permutation._round_key(42, turn, part) for part in "abc")
            square = (((low * a + b) % permutation.PRIME) ** 2 + c) % permutation.PRIME
            high, low = low, (high + square) % base
        return high * base + low

    numbers = [*range(rows), *range(rows)]
    expected, walks = [], 0
    for number in numbers:
        place = mixed(number)
        walks += place >= rows
        while place >= rows:
            place = mixed(place)
        expected.append((number, place))
    found = spark.createDataFrame([(n,) for n in numbers], "n bigint").select(
        "n", permutation.place_of(F.col("n"), rows, 42).alias("p")
    )
    assert walks and Counter(map(tuple, found.collect())) == Counter(expected)


def test_too_many_rows():
    with pytest.raises(ValueError):
        permutation.place_of(F.lit(0), permutation.PRIME**2 + 1, 1)


def test_numbers_are_gapless(spark):
    df = spark.range(0, 1_000, 1, 7).where("id % 5 <> 0 or id > 400").selectExpr("1 as same", "id as number", "2 as at")
    numbered, count = permutation.numbered(df)
    found = numbered.collect()
    assert sorted(r["number"] for r in found) == list(range(count)) and count == df.count()
    assert numbered.select("item.*").columns == df.columns


def test_rows_in_random_order(spark):
    df = spark.range(0, 10_000, 1, 8).selectExpr("id", "id % 3 as place", "'x' as item")
    out = permutation.permute_rows(df, 42, partitions=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan.lower()
    assert out.columns == df.columns
    parts = [[r["id"] for r in part] for part in out.rdd.glom().collect()]
    assert [len(p) for p in parts] == [2_500] * 4
    ids = [i for p in parts for i in p]
    assert sorted(ids) == list(range(10_000)) and ids != sorted(ids)
    assert all(len([i for i in p if i < 5_000]) > 1_000 for p in parts)


def test_repeated_and_no_rows(spark):
    same = spark.range(0, 1_000, 1, 3).selectExpr("1 as k")
    assert Counter(map(tuple, permutation.permute_rows(same, 1, 5).collect())) == {(1,): 1_000}
    assert permutation.permute_rows(same.limit(0), 1).count() == 0
