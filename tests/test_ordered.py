"""Sliced running totals and neighbours against plain windows."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from evenkeel.operators.ordered import running_totals, with_previous


@pytest.mark.parametrize("slices", [1, 3, 8])
def test_running_totals(spark, slices):
    rows = spark.range(2000).select(
        (F.col("id") % 3).alias("g"), F.xxhash64("id").alias("k"), (F.col("id") % 11).alias("v")
    )
    found = running_totals(rows, [F.desc("k")], {"upto": F.col("v"), "nth": F.lit(1)}, ["g"], slices)
    window = Window.partitionBy("g").orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy("g")
    expected = rows.select(
        "g", "k", "v", F.sum("v").over(window).alias("upto"), F.count("v").over(window).alias("nth"),
        F.sum("v").over(group).alias("all_upto"), F.count("v").over(group).alias("all_nth"),
    )
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("slices", [1, 4, 50])
def test_previous_row(spark, slices):
    rows = spark.range(30).select((F.col("id") % 7).alias("x"), F.col("id").alias("y"))
    found = {
        (r["x"], r["y"]): (r["previous_x"], r["previous_y"]) for r in with_previous(rows, ["x", "y"], slices).collect()
    }
    ordered = sorted(found)
    assert len(ordered) == 30 and found[ordered[0]] == (None, None)
    assert all(found[b] == a for a, b in zip(ordered, ordered[1:]))


def test_no_task_sees_the_whole_table(spark):
    rows = spark.range(8000).withColumnRenamed("id", "k")
    found = running_totals(rows, ["k"], {"nth": F.lit(1)}, slices=8)
    sizes = [r["count"] for r in found.groupBy((F.col("k") / 1000).cast("int")).count().collect()]
    assert sum(sizes) == 8000
    spread = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in spread) < 8000


def test_empty_table(spark):
    rows = spark.createDataFrame([], "k bigint")
    assert running_totals(rows, ["k"], {"nth": F.lit(1)}).collect() == []
    assert with_previous(rows, ["k"]).collect() == []


def test_a_null_group_is_a_group(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 5)], "g string, v long")
    out = running_totals(df, order=["v"], totals={"upto": F.col("v")}, groups=["g"])
    assert sorted(((r["g"] or ""), r["v"], r["upto"], r["all_upto"]) for r in out.collect()) == [
        ("", 2, 2, 7), ("", 5, 7, 7), ("a", 1, 1, 1)
    ]
