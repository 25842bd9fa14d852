"""The jobs, from files to files."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.operators.balance import hold_out
from evenkeel.operators.roc import area_under_curve
from evenkeel.operators.rows import conform, enrich, enrich_spread
from evenkeel.plans.classifier import evaluate, exact_curve, fit_balanced, submission, thinned_curve
from evenkeel.plans.features import FittedFeatures, fit_features
from evenkeel.sources.artifacts import load_classifier, save_model
from evenkeel.sources.evidence import against_spec, csv_evidence
from evenkeel.sources.tables import read_csv, read_parquet, write_csv, write_parquet
from evenkeel.spec import FeatureSpec
from evenkeel.staging import scratch, stage, staged


def read_joined(
    spark: SparkSession,
    facts: str,
    details: str,
    spec: FeatureSpec,
    salts: int = 1,
    malformed: str = "FAILFAST",
    hot_keys: bool = False,
) -> DataFrame:
    """Both CSV tables, joined on the key; facts without details are kept. ``hot_keys`` parses the facts into a written
    table first and spreads the keys that it finds to be hot there, and no others."""
    types = spec.types()
    rows = read_csv(spark, facts, types, malformed=malformed)
    more = read_csv(spark, details, types, malformed=malformed)
    if hot_keys:
        return enrich_spread(stage(rows, "facts"), more, spec.key)
    return enrich(rows, more, spec.key, salts)


def propose_types(
    spark: SparkSession, table: str, report_out: str, spec: FeatureSpec | None = None, multi_line: bool = False
) -> None:
    """What the cells of a CSV table say about its columns' types, as one CSV file with a row per column; with ``spec``,
    whether they can be read as it declares them."""
    evidence = csv_evidence(spark, table, multi_line=multi_line)
    write_csv(evidence if spec is None else against_spec(evidence, spec), report_out, files=1)


def build_training_features(
    spark: SparkSession,
    spec: FeatureSpec,
    facts: str,
    details: str,
    features_out: str,
    state_out: str,
    salts: int = 1,
    malformed: str = "FAILFAST",
    hot_keys: bool = False,
    **fit_options,
) -> FittedFeatures:
    """CSV tables to a feature table, and the fitted stages saved.

    Text parsing and the join run once; fitting and applying read the staged rows.
    """
    with scratch(spark):
        joined = conform(read_joined(spark, facts, details, spec, salts, malformed, hot_keys), spec)
        with staged(joined, "rows") as rows:
            fitted = fit_features(rows, spec, stage_rows=False, **fit_options)
            fitted.save(state_out)
            write_parquet(fitted.feature_table(rows), features_out)
    return FittedFeatures.load(spark, state_out)


def train(
    spark: SparkSession,
    features: str,
    label: str,
    key: str,
    model_out: str,
    report_out: str,
    curve_out: str,
    hold_out_share: float = 0.0,
    held_out: str | None = None,
    curve_points: int | None = None,
    **fit_options,
) -> LogisticRegressionModel:
    """Feature table to a saved classifier, with its metrics and exact curve on the balanced training rows.

    The report also tells the rows of either class before balancing, and those without a label. With a share to hold
    out, rows are split by their key before balancing, and the ones held out are written as a feature table. With
    ``curve_points`` the curve has so many points at most, and the report tells how far its area may be off.
    """
    if bool(hold_out_share) != bool(held_out):
        raise ValueError("a share to hold out and a place for it go together")
    rows, held = hold_out(read_parquet(spark, features), key, hold_out_share)
    if held_out:
        write_parquet(held, held_out)
    with scratch(spark):
        fit = fit_balanced(rows, label, key, **fit_options)
        save_model(fit.model, model_out)
        # Weights only matter to the fit; the report counts rows.
        report = evaluate(fit.model, fit.rows, label).unionByName(fit.sizes_report())
        _write_evaluation(fit.model, fit.rows.drop("weight"), label, report, report_out, curve_out, curve_points)
    return load_classifier(model_out)


def build_scoring_features(
    spark: SparkSession,
    facts: str,
    details: str,
    state: str,
    features_out: str,
    fill: str = "impute",
    salts: int = 1,
    malformed: str = "FAILFAST",
    hot_keys: bool = False,
) -> None:
    """New CSV tables through the saved stages."""
    fitted = FittedFeatures.load(spark, state)
    rows = read_joined(spark, facts, details, fitted.spec, salts, malformed, hot_keys)
    write_parquet(fitted.feature_table(rows, fill), features_out)


def score_to_csv(
    spark: SparkSession, features: str, model: str, key: str, label: str, out: str, files: int | None = None
) -> None:
    """Feature table through the saved classifier to ``key,label`` lines."""
    write_csv(submission(load_classifier(model), read_parquet(spark, features), key, label), out, files)


def evaluate_table(
    spark: SparkSession,
    features: str,
    model: str,
    label: str,
    report_out: str,
    curve_out: str,
    curve_points: int | None = None,
) -> None:
    """Metrics and curve of a saved classifier on any labelled feature table; ``curve_points`` as for ``train``."""
    classifier, rows = load_classifier(model), read_parquet(spark, features)
    with scratch(spark):
        report = evaluate(classifier, rows, label)
        _write_evaluation(classifier, rows, label, report, report_out, curve_out, curve_points)


def _write_evaluation(
    model: LogisticRegressionModel,
    rows: DataFrame,
    label: str,
    report: DataFrame,
    report_out: str,
    curve_out: str,
    curve_points: int | None,
) -> None:
    if curve_points is None:
        curve = exact_curve(model, rows, label)
    else:
        thinned = stage(thinned_curve(model, rows, label, curve_points), "curve")
        curve = thinned.select("FPR", "TPR")
        off = thinned.agg(F.sum("bound").alias("value"))
        bound = off.select(F.lit("curve_area_bound").alias("metric"), F.lit(None).cast("double").alias("label"), "value")
        report = report.unionByName(bound)
    write_parquet(report.coalesce(1), report_out)
    write_csv(curve, curve_out)


def curve_area(spark: SparkSession, curve: str, out: str) -> None:
    """Area under a stored curve, as one row ``(area)``."""
    with scratch(spark):
        points = read_csv(spark, curve, {"FPR": T.DoubleType(), "TPR": T.DoubleType()})
        write_parquet(area_under_curve(points).coalesce(1), out)
