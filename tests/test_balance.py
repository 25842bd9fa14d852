"""Balancing: who is copied, how often, and what is refused."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from evenkeel.operators import balance


def frame(spark, positives, negatives, unlabelled=0):
    total = positives + negatives + unlabelled
    label = (
        F.when(F.col("id") < positives, 1).when(F.col("id") < positives + negatives, 0)
    )
    return spark.range(total).select("id", label.cast("int").alias("y"))


def test_null_labels_are_in_neither_class_but_counted(spark):
    df = frame(spark, 3, 6, 2)
    positives, negatives = balance.split_classes(df, "y")
    assert (positives.count(), negatives.count()) == (3, 6)
    assert balance.checked_balance(df, "y") == balance.ClassBalance(3, 6, 2)
    assert {r["label"]: r["n"] for r in balance.class_counts(df, "y").collect()} == {1: 3, 0: 6, None: 2}


@pytest.mark.parametrize("positives, negatives", [(0, 5), (5, 0), (0, 0)])
def test_both_classes_are_needed(spark, positives, negatives):
    with pytest.raises(ValueError, match="both classes"):
        balance.balance_classes(frame(spark, positives, negatives), "y", "id")


def test_more_positives_must_be_asked_for(spark):
    df = frame(spark, 400, 100)
    for mode in ("replicate", "poisson"):
        with pytest.raises(ValueError, match="outnumber"):
            balance.balance_classes(df, "y", "id", mode=mode)
        thinned, _ = balance.balance_classes(df, "y", "id", mode=mode, allow_undersampling=True)
        assert 60 < thinned.where("y = 1").count() < 140
        assert thinned.where("y = 0").count() == 100


@pytest.mark.parametrize("mode", ["replicate", "poisson"])
def test_oversampled_rows_are_originals(spark, mode):
    df = frame(spark, 100, 1030, 10)
    balanced, sizes = balance.balance_classes(df, "y", "id", mode=mode)
    counts = {r["y"]: r["n"] for r in balanced.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert counts[0] == 1030 and 900 < counts[1] < 1160 and None not in counts
    assert balanced.columns == ["id", "y"]
    assert balanced.where("y = 0").distinct().count() == 1030
    assert balanced.where("y = 1").join(df.where("y = 1"), ["id", "y"], "left_anti").isEmpty()
    assert sizes.ratio == 10.3


def test_replication_does_not_depend_on_partitioning(spark):
    df = frame(spark, 100, 1030)
    one, other = (
        balance.balance_classes(df.repartition(n), "y", "id")[0].groupBy("id").count() for n in (1, 7)
    )
    assert one.exceptAll(other).isEmpty()
    assert {r["count"] for r in one.where("id < 100").select("count").distinct().collect()} == {10, 11}


def test_extra_copies_are_spread_over_small_keys(spark):
    keys = spark.range(1, 1001).select(F.col("id").alias("k"))
    for part in (0.1, 0.3, 0.5, 0.9):
        extra = keys.agg(F.sum(balance.copies("k", 5 + part) - 5)).first()[0]
        assert abs(extra / 1000 - part) < 0.05


def test_null_key_keeps_its_whole_copies(spark):
    df = spark.createDataFrame([(None, 1), (2, 0), (3, 0), (4, 0)], "k int, y int")
    balanced, _ = balance.balance_classes(df, "y", "k")
    assert balanced.where("y = 1").count() == 3


def test_weights_balance_without_copies(spark):
    weighted, _ = balance.balance_classes(frame(spark, 10, 35, 5), "y", "id", mode="weight")
    sums = {r["y"]: r["w"] for r in weighted.groupBy("y").agg(F.sum("weight").alias("w")).collect()}
    assert sums == {1: 35.0, 0: 35.0}


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode is one of"):
        balance.balance_classes(frame(spark, 1, 1), "y", "id", mode="smote")


def test_shuffle_keeps_rows_and_is_repeatable(spark):
    df = spark.range(1000)
    first, second = ([r["id"] for r in balance.shuffle_rows(df, 7, 4).collect()] for _ in range(2))
    assert first == second and first != sorted(first) and sorted(first) == list(range(1000))
    assert balance.shuffle_rows(df, 7, 4).rdd.getNumPartitions() <= 4


def test_counting_is_one_scan(spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    plan = balance.class_balance(labels, "toxic")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_other_labels_are_refused(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(20)], "k int, y int")
    for mode in balance.MODES:
        with pytest.raises(ValueError, match="10 rows have others, from 2 to 3"):
            balance.balance_classes(df, "y", "k", mode=mode)


def test_held_out_rows_follow_the_key(spark):
    df = spark.range(2000).selectExpr("if(id % 100 = 0, null, id div 2) as k", "id")
    fit, held = balance.hold_out(df, "k", 0.25)
    assert fit.count() + held.count() == 2000 and 350 < held.count() < 650
    assert held.where("k is null").count() == 0
    assert fit.where("k is not null").join(held, "k").count() == 0
    again = balance.hold_out(df.repartition(7), "k", 0.25)[1]
    assert sorted(r["id"] for r in again.collect()) == sorted(r["id"] for r in held.collect())
    assert balance.hold_out(df, "k", 0.0)[1].count() == 0
    with pytest.raises(ValueError, match="from 0 up to 1"):
        balance.hold_out(df, "k", 1.0)


def test_shuffle_sorts_in_all_partitions(spark):
    out = balance.shuffle_rows(spark.range(4000, numPartitions=8), partitions=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "RANGE" in plan.upper()
    ids = [r["id"] for r in out.collect()]
    assert sorted(ids) == list(range(4000)) and ids != sorted(ids)
    assert out.rdd.getNumPartitions() == 4 and [r["id"] for r in out.collect()] == ids


def test_poisson_draw_follows_the_keys(spark):
    """Equal on any partitioning; numbers of copies are Poisson; large means are drawn in parts; repeated keys differ."""
    df = spark.range(6000).selectExpr("id as k", "if(id % 3 = 0, 1, 0) as y", "id as v")
    first = balance.oversample_poisson(df, "y", "k", 2.5)
    again = balance.oversample_poisson(df.repartition(7, "v"), "y", "k", 2.5)
    assert first.columns == df.columns and first.exceptAll(again).isEmpty() and again.exceptAll(first).isEmpty()
    for mean in (0.3, 2.5, 40.0):
        copies = df.select(balance.poisson_copies(F.col("k").cast("string"), mean).alias("n"))
        told = copies.agg(F.avg("n"), F.var_samp("n"), F.min("n")).first()
        assert abs(told[0] - mean) < 5 * (mean / 6000) ** 0.5 and abs(told[1] / mean - 1) < 0.15
    one = spark.range(0, 3000, 1, 6).selectExpr("1 as k", "1 as y", "id as v").unionByName(
        spark.createDataFrame([(None, 1, 1), (None, 1, 2), (2, 0, 3)], "k int, y int, v bigint")
    )
    drawn = balance.oversample_poisson(one, "y", "k", 1.0)
    counts = {r["v"]: r["count"] for r in drawn.where("k = 1").groupBy("v").count().collect()}
    assert 1700 < len(counts) < 2100 and 2700 < sum(counts.values()) < 3300
    assert drawn.where("y = 0").count() == 1
    same = balance.oversample_poisson(one.repartition(9), "y", "k", 1.0)
    assert drawn.exceptAll(same).isEmpty() and same.exceptAll(drawn).isEmpty()


def test_folded_rows(spark):
    vectors = [Vectors.sparse(3, {0: 1.0}), Vectors.sparse(3, {2: 4.0}), Vectors.dense(1.0, 0.0, 0.0), None]
    rows = [(vectors[i % 4], (None, 0, 1, 1)[i % 7 % 4], float(i % 3)) for i in range(840)]
    fields = [StructField("features", VectorUDT()), StructField("y", IntegerType()), StructField("w", DoubleType())]
    df = spark.createDataFrame(rows, StructType(fields))
    for weight in (None, "w"):
        want = Counter()
        for v, y, w in rows:
            if v is not None and y is not None:
                want[str(v), y] += w if weight else 1.0
        found = balance.fold_rows(df, "y", weight=weight).collect()
        assert {(str(r["features"]), r["y"]): r["weight"] for r in found} == want and len(found) == len(want)
    assert balance.fold_rows(df.limit(0), "y").count() == 0


def test_folding_counts_hot_rows_before_the_shuffle(spark):
    hot = spark.range(0, 9_000, 1, 6).select(
        array_to_vector(F.array((F.col("id") % 3 % 2).cast("double"))).alias("features"), (F.col("id") % 2).alias("y")
    )
    plan = balance.fold_rows(hot, "y")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "SortAggregate" not in plan
    assert balance.fold_rows(hot, "y").agg(F.count("*"), F.sum("weight")).first() == (4, 9_000.0)
