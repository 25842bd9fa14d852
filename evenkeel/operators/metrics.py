"""Evaluation of predictions, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.operators.roc import area_under_roc
from evenkeel.staging import stage


def confusion_matrix(scored: DataFrame, label: str, prediction: str, weight: Column | None = None) -> DataFrame:
    """``(label, prediction, n)`` for rows with a label; ``weight`` counts a row several times."""
    return (
        scored.where(F.col(label).isNotNull())
        .groupBy(F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction"))
        .agg(F.sum(F.lit(1) if weight is None else weight).alias("n"))
    )


def label_list(df: DataFrame, label: str) -> DataFrame:
    """The distinct labels."""
    return df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label")).distinct()


def accuracy(matrix: DataFrame) -> DataFrame:
    """One row ``(accuracy)`` from a confusion matrix."""
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return matrix.agg((right / F.sum("n")).alias("accuracy"))


def rates_by_label(matrix: DataFrame) -> DataFrame:
    """``(label, precision, recall, true_positive_rate, false_positive_rate)`` per true label.

    Precision is 0 for a label that was never predicted; the false positive rate
    is null if there is no other label.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    as_truth = F.struct(
        F.col("label").alias("label"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted"),
        hit.alias("hits"),
    )
    as_guess = F.struct(
        F.col("prediction").alias("label"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("predicted"),
        F.lit(0).cast("bigint").alias("hits"),
    )
    per_label = (
        matrix.select(F.explode(F.array(as_truth, as_guess)).alias("s"))
        .groupBy("s.label")
        .agg(*[F.sum(f"s.{c}").alias(c) for c in ("actual", "predicted", "hits")])
        # One row per label.
        .withColumn("total", F.sum("actual").over(Window.partitionBy()))
        .where(F.col("actual") > 0)
    )
    recall = F.col("hits") / F.col("actual")
    return per_label.select(
        "label",
        F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0)).alias("precision"),
        recall.alias("recall"),
        recall.alias("true_positive_rate"),
        F.try_divide(F.col("predicted") - F.col("hits"), F.col("total") - F.col("actual")).alias("false_positive_rate"),
    )


def metrics_report(scored: DataFrame, label: str, prediction: str, score: str) -> DataFrame:
    """``(metric, label, value)``: all metrics of a binary prediction in long form.

    The rows are reduced once to counts per score; all metrics come from these.
    """
    counts = stage(
        scored.where(F.col(label).isNotNull())
        .groupBy(
            F.col(label).cast("double").alias("label"),
            F.col(prediction).cast("double").alias("prediction"),
            F.col(score).cast("double").alias("score"),
        )
        .agg(F.count(F.lit(1)).alias("times")),
        "scores",
    )
    matrix = confusion_matrix(counts, "label", "prediction", weight=F.col("times"))
    by_label = rates_by_label(matrix)
    names = ("precision", "recall", "false_positive_rate", "true_positive_rate")
    long = by_label.select(
        F.explode(F.array(
            F.struct(F.lit("label").alias("metric"), "label", F.col("label").alias("value")),
            *[F.struct(F.lit(m).alias("metric"), "label", F.col(m).alias("value")) for m in names],
        )).alias("s")
    ).select("s.*")
    whole = F.lit(None).cast("double").alias("label")
    return (
        long.unionByName(
            accuracy(matrix).select(F.lit("accuracy").alias("metric"), whole, F.col("accuracy").alias("value"))
        )
        .unionByName(
            area_under_roc(counts, "label", "score", weight=F.col("times")).select(
                F.lit("area_under_roc").alias("metric"), whole, F.col("area").alias("value")
            )
        )
    )
