"""Receiver operating characteristic, exact for any number of rows and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.operators.ordered import running_totals, with_previous

# Fixed value: points of the published curve.
CURVE_POINTS = 104


def _score_totals(scored: DataFrame, label: str, score: str, weight: Column | None) -> DataFrame:
    """One row per distinct score, with the positives and negatives at or above it."""
    times = F.lit(1) if weight is None else weight
    per_score = (
        scored.where(F.col(label).isin(0, 1))
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(
            F.sum(F.when(F.col(label) == 1, times).otherwise(0)).alias("positives"),
            F.sum(F.when(F.col(label) == 0, times).otherwise(0)).alias("negatives"),
        )
    )
    return running_totals(
        per_score,
        order=[F.desc("score")],
        totals={"tp": F.col("positives"), "fp": F.col("negatives")},
    )


def _points(scored: DataFrame, label: str, score: str, weight: Column | None) -> DataFrame:
    return _score_totals(scored, label, score, weight).select(
        (F.col("fp") / F.col("all_fp")).alias("FPR"), (F.col("tp") / F.col("all_tp")).alias("TPR")
    )


def _corners(spark: SparkSession) -> DataFrame:
    corner = F.col("id").cast("double")
    return spark.range(2).select(corner.alias("FPR"), corner.alias("TPR"))


def roc_curve(scored: DataFrame, label: str, score: str, weight: Column | None = None) -> DataFrame:
    """``(FPR, TPR)``: one point per distinct score, plus (0, 0) and (1, 1).

    As the lowest score reaches (1, 1) by itself, that point occurs twice.
    """
    return _corners(scored.sparkSession).unionByName(_points(scored, label, score, weight))


def bounded_curve(
    scored: DataFrame, label: str, score: str, points: int = CURVE_POINTS, weight: Column | None = None
) -> DataFrame:
    """``(FPR, TPR, bound)``: at most ``points`` points of the exact curve, each once, however many scores there are.

    The way from (0, 0) to (1, 1), right and up together, is cut into equal cells; the first and the last point of each
    are kept, so steps from cell to cell are those of the exact curve. Inside a cell a rising curve stays in the
    rectangle between both points: the area under the step that ends at a point is off by half of it at most, which is
    ``bound``. All bounds together are below 1 / (``points`` - 3). Every task folds its points into cells before any
    shuffle.
    """
    if points < 4:
        raise ValueError(f"4 points or more, not {points!r}")
    cells = (points - 2) // 2
    at = F.least(F.floor((F.col("FPR") + F.col("TPR")) / 2 * cells), F.lit(cells - 1))
    ends = _points(scored, label, score, weight).groupBy(at.alias("cell")).agg(
        F.min(F.struct("FPR", "TPR")).alias("first"), F.max(F.struct("FPR", "TPR")).alias("last"),
        F.count(F.lit(1)).alias("n"),
    )
    # Two points are a step of the exact curve.
    off = (F.col("last.FPR") - F.col("first.FPR")) * (F.col("last.TPR") - F.col("first.TPR")) / 2
    exact = F.lit(0.0)
    kept = ends.select(
        F.explode(
            F.array(
                F.struct("first.FPR", "first.TPR", exact.alias("bound")),
                F.struct("last.FPR", "last.TPR", F.when(F.col("n") > 2, off).otherwise(exact).alias("bound")),
            )
        ).alias("point")
    ).select("point.*")
    every = kept.unionByName(_corners(scored.sparkSession).withColumn("bound", exact))
    return every.groupBy("FPR", "TPR").agg(F.max("bound").alias("bound"))


def area_under_roc(scored: DataFrame, label: str, score: str, weight: Column | None = None) -> DataFrame:
    """One row ``(area)``: trapezoids under the exact curve.

    Each score adds its negatives times the positives above it, plus half of those that
    share it. Null if a class is missing.
    """
    totals = _score_totals(scored, label, score, weight)
    positives_passed = F.col("tp").cast("double") - F.col("positives") / 2
    return totals.agg(
        F.try_divide(
            F.sum(F.col("negatives") * positives_passed),
            F.max("all_fp").cast("double") * F.max("all_tp").cast("double"),
        ).alias("area")
    )


def area_under_curve(curve: DataFrame, x: str = "FPR", y: str = "TPR") -> DataFrame:
    """One row ``(area)``: trapezoids under a stored rising curve, in any row order."""
    points = curve.select(F.col(x).alias("x"), F.col(y).alias("y")).distinct()
    steps = with_previous(points, ["x", "y"])
    width = F.col("x") - F.col("previous_x")
    return steps.agg(F.sum(width * (F.col("y") + F.col("previous_y")) / 2).alias("area"))
