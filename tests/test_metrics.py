"""Metrics and curves against Spark ML's own evaluation and hand-made cases."""

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.mllib.evaluation import MulticlassMetrics
from pyspark.sql import functions as F

from evenkeel.operators import metrics, roc
from evenkeel.sources import tables

EVENTS = "/root/testdata/sf0.01/events.parquet"


def events(spark):
    return spark.read.parquet(EVENTS).select(
        (F.col("event_type") == "error").cast("double").alias("label"),
        (F.col("value") > 50).cast("double").alias("prediction"),
        F.col("value").alias("score"),
    )


def scored(spark, *rows):
    return spark.createDataFrame(list(rows), "label int, score double")


def curve(df):
    return sorted((r["FPR"], r["TPR"]) for r in roc.roc_curve(df, "label", "score").collect())


def test_rates_equal_spark(spark):
    df = events(spark)
    own = MulticlassMetrics(df.select("prediction", "label").rdd.map(tuple))
    matrix = metrics.confusion_matrix(df, "label", "prediction")
    assert metrics.accuracy(matrix).first()["accuracy"] == pytest.approx(own.accuracy)
    rates = {r["label"]: r for r in metrics.rates_by_label(matrix).collect()}
    for label in (0.0, 1.0):
        assert rates[label]["precision"] == pytest.approx(own.precision(label))
        assert rates[label]["recall"] == pytest.approx(own.recall(label))
        assert rates[label]["true_positive_rate"] == pytest.approx(own.truePositiveRate(label))
        assert rates[label]["false_positive_rate"] == pytest.approx(own.falsePositiveRate(label))


def test_rates_are_consistent_with_each_other(spark):
    matrix = metrics.confusion_matrix(events(spark), "label", "prediction")
    rates = {r["label"]: r for r in metrics.rates_by_label(matrix).collect()}
    assert rates[0.0]["false_positive_rate"] == pytest.approx(1 - rates[1.0]["recall"])
    assert rates[1.0]["false_positive_rate"] == pytest.approx(1 - rates[0.0]["recall"])


def test_label_that_is_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (None, 1.0)], "label double, prediction double")
    matrix = metrics.confusion_matrix(df, "label", "prediction")
    assert [tuple(r) for r in metrics.rates_by_label(matrix).orderBy("label").collect()] == [
        (0.0, 0.5, 1.0, 1.0, 1.0), (1.0, 0.0, 0.0, 0.0, 0.0),
    ]


def test_exact_area_equals_evaluator_without_bins(spark):
    df = events(spark)
    own = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert roc.area_under_roc(df, "label", "score").first()["area"] == pytest.approx(own, abs=1e-12)


def test_curve_has_one_point_per_score_and_rises(spark):
    df = events(spark)
    points = curve(df)
    assert len(points) == df.select("score").distinct().count() + 2
    assert points[0] == (0.0, 0.0) and points[-2:] == [(1.0, 1.0), (1.0, 1.0)]
    assert [y for _, y in points] == sorted(y for _, y in points)


def test_ties_across_classes_are_one_point(spark):
    df = scored(spark, (1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1), (None, 0.7))
    assert curve(df) == [(0.0, 0.0), (0.0, 0.5), (0.5, 1.0), (1.0, 1.0), (1.0, 1.0)]
    assert roc.area_under_roc(df, "label", "score").first()["area"] == 0.875


def test_area_of_one_class_is_null(spark):
    assert roc.area_under_roc(scored(spark, (1, 0.9), (1, 0.2)), "label", "score").first()["area"] is None


def test_a_score_shared_by_a_third_of_the_rows(spark):
    df = spark.range(30000).select(
        (F.col("id") % 7 == 0).cast("int").alias("label"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 30000).alias("score"),
    )
    own = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(df)
    assert roc.area_under_roc(df, "label", "score").first()["area"] == pytest.approx(own, abs=1e-12)


def test_stored_curve_in_any_order(spark, tmp_path):
    path = str(tmp_path / "curve")
    tables.write_csv(roc.roc_curve(events(spark), "label", "score").orderBy(F.rand(1)), path)
    stored = spark.read.schema("FPR double, TPR double").csv(path, header=True)
    exact = roc.area_under_roc(events(spark), "label", "score").first()["area"]
    assert roc.area_under_curve(stored).first()["area"] == pytest.approx(exact, abs=1e-12)


def test_area_under_a_small_curve(spark):
    points = [(0.0, 0.0), (0.0, 0.5), (0.5, 0.5), (1.0, 1.0), (1.0, 1.0)]
    assert roc.area_under_curve(spark.createDataFrame(points, "FPR double, TPR double")).first()["area"] == 0.625


def test_report_holds_all_metrics(spark):
    report = metrics.metrics_report(events(spark), "label", "prediction", "score").collect()
    assert len(report) == 12
    assert {r["metric"] for r in report if r["label"] is None} == {"accuracy", "area_under_roc"}


def test_bounded_curve(spark):
    df = events(spark)
    exact = {tuple(r) for r in roc.roc_curve(df, "label", "score").collect()}
    area = roc.area_under_roc(df, "label", "score").first()["area"]
    for points in (4, 5, 30, 104, 1_000_000):
        thinned = roc.bounded_curve(df, "label", "score", points)
        rows = [tuple(r) for r in thinned.collect()]
        kept, bound = {r[:2] for r in rows}, sum(r[2] for r in rows)
        assert len(kept) == len(rows) <= points and kept <= exact
        assert bound <= 1 / (points - 3)
        off = abs(roc.area_under_curve(thinned).first()["area"] - area)
        assert off <= bound + 1e-12
    # Enough points for every score: the exact curve.
    assert kept == exact and bound == 0
    with pytest.raises(ValueError, match="4 points"):
        roc.bounded_curve(df, "label", "score", 3)


def test_bounded_curve_of_few_scores(spark):
    df = scored(spark, (1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1), (None, 0.7))
    rows = sorted(tuple(r) for r in roc.bounded_curve(df, "label", "score").collect())
    assert rows == [(0.0, 0.0, 0.0), (0.0, 0.5, 0.0), (0.5, 1.0, 0.0), (1.0, 1.0, 0.0)]
