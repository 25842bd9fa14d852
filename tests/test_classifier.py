"""Fitting, scoring, saving, and the jobs end to end."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from catalog.queries import document_spec, wide_documents
from evenkeel.__main__ import main
from evenkeel.functions.scalars import logistic
from evenkeel.plans import classifier, jobs
from evenkeel.sources import artifacts, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1200):
        x = rng.normal(size=3)
        y = int(rng.random() < 1 / (1 + np.exp(-(1.5 * x[0] - x[1] - 2))))
        rows.append((i, Vectors.dense(x), y))
    return spark.createDataFrame(rows, ["id", "features", "y"]).cache()


@pytest.fixture(scope="module")
def model(features):
    return classifier.fit_classifier(features, "y", "id")


def test_settings(model):
    assert (model.getMaxIter(), model.getRegParam(), model.getElasticNetParam(), model.getThreshold()) == (
        10, 0, 0, 0.5
    )
    assert model.summary.totalIterations <= 10


def test_scored_columns(model, features):
    assert classifier.score(model, features).columns == [
        "id", "features", "y", "rawPrediction", "probability", "predictions",
    ]


def test_expression_equals_model(model, features):
    values = vector_to_array("features")
    own = logistic([values[i] for i in range(3)], model.coefficients, model.intercept)
    scored = classifier.score(model, features).withColumn("own", own)
    worst = scored.agg(
        F.max(F.abs(F.col("own") - vector_to_array("probability")[1])),
        F.max(F.abs((F.col("own") > 0.5).cast("double") - F.col("predictions"))),
    ).first()
    assert worst[0] < 1e-14 and worst[1] == 0


def test_save_and_load(spark, model, features, tmp_path):
    artifacts.save_model(model, str(tmp_path / "m"))
    artifacts.save_model(model, str(tmp_path / "m"))
    loaded = artifacts.load_classifier(str(tmp_path / "m"))
    assert loaded.coefficients == model.coefficients and not loaded.hasSummary
    same = classifier.score(loaded, features).exceptAll(classifier.score(model, features))
    assert same.isEmpty()


@pytest.mark.parametrize("mode", ["poisson", "replicate", "weight"])
def test_balancing_finds_more_positives(features, mode):
    def recall(m):
        report = classifier.evaluate(m, features, "y").where("metric = 'recall' and label = 1.0")
        return report.first()["value"]

    plain = classifier.fit_classifier(features, "y", "id", mode="none")
    assert recall(classifier.fit_classifier(features, "y", "id", mode=mode)) > recall(plain) + 0.1


def test_row_order_does_not_matter(features, model):
    shuffled = classifier.fit_classifier(features, "y", "id", shuffle=True, partitions=4)
    assert np.allclose(shuffled.coefficients, model.coefficients, atol=1e-6)


def test_more_iterations_flatten_the_gradient(features):
    model = classifier.fit_classifier(features, "y", "id", mode="none", max_iter=100, tolerance=1e-10)
    rows = [(r["features"].toArray(), r["y"], r["probability"][1]) for r in classifier.score(model, features).collect()]
    gradient = sum((p - y) * x for x, y, p in rows) / len(rows)
    assert np.abs(gradient).max() < 1e-5


def test_summary_and_evaluation_agree_on_the_same_rows(features):
    model = classifier.fit_classifier(features, "y", "id", mode="none")
    of_summary, of_rows = (
        {(r["metric"], r["label"]): r["value"] for r in report.collect()}
        for report in (classifier.summary_report(model.summary, features), classifier.evaluate(model, features, "y"))
    )
    assert of_summary.keys() == of_rows.keys()
    for name, value in of_summary.items():
        assert of_rows[name] == pytest.approx(value, abs=1e-3 if name[0] == "area_under_roc" else 1e-12)


def test_missing_labels_are_left_out_of_the_fit(features, spark):
    holes = features.withColumn("y", F.when(F.col("id") % 4 != 0, F.col("y")))
    kept = features.where("id % 4 != 0")
    one, other = (classifier.fit_classifier(df, "y", "id", mode="replicate") for df in (holes, kept))
    assert np.allclose(one.coefficients, other.coefficients, atol=1e-9)


def test_one_class_is_refused(features):
    with pytest.raises(ValueError, match="both classes"):
        classifier.fit_classifier(features.where("y = 0"), "y", "id")


def test_scoring_stays_inside_spark_sql(spark, model, features, tmp_path):
    tables.write_parquet(features, str(tmp_path / "f"))
    stored = tables.read_parquet(spark, str(tmp_path / "f"))
    plan = classifier.submission(model, stored, "id", "y")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,features:" in plan
    assert not any(word in plan for word in ("RDD", "Python", "Exchange"))


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("jobs"))
    data = wide_documents(spark, SF).drop("quality")
    tables.write_csv(data.select("doc_id", "lang", "source", "n_chars", "toxic"), f"{at}/facts")
    tables.write_csv(data.drop("lang", "source", "n_chars", "toxic").where("E0 is not null"), f"{at}/details")
    return at


def test_jobs(spark, files):
    spec = document_spec(components=5)
    jobs.build_training_features(spark, spec, f"{files}/facts", f"{files}/details", f"{files}/train", f"{files}/state")
    model = jobs.train(
        spark, f"{files}/train", "toxic", "doc_id", f"{files}/model", f"{files}/report", f"{files}/curve"
    )
    report = {(r["metric"], r["label"]): r["value"] for r in spark.read.parquet(f"{files}/report").collect()}
    assert len(report) == 15
    known = spark.read.parquet(f"{files}/train").groupBy("toxic").count().collect()
    assert {(r["toxic"], float(r["count"])) for r in known} == {(k, v) for (m, k), v in report.items() if m == "rows"}
    curve = spark.read.csv(f"{files}/curve", header=True, inferSchema=True)
    assert curve.columns == ["FPR", "TPR"] and curve.count() > 2 and not model.hasSummary
    jobs.curve_area(spark, f"{files}/curve", f"{files}/area")
    assert spark.read.parquet(f"{files}/area").first()["area"] == pytest.approx(report["area_under_roc", None])
    jobs.build_scoring_features(spark, f"{files}/facts", f"{files}/details", f"{files}/state", f"{files}/score")
    jobs.score_to_csv(spark, f"{files}/score", f"{files}/model", "doc_id", "toxic", f"{files}/out")
    out = spark.read.csv(f"{files}/out", header=True, inferSchema=True)
    assert out.columns == ["doc_id", "toxic"] and out.count() == 200
    assert out.where("toxic between 0 and 1").count() == 200
    jobs.evaluate_table(spark, f"{files}/score", f"{files}/model", "toxic", f"{files}/evaluation", f"{files}/curve2")
    assert spark.read.parquet(f"{files}/evaluation").count() == 12
    assert spark.read.csv(f"{files}/curve2", header=True).count() > 2


def test_command_line(spark, files, tmp_path):
    spec = tmp_path / "spec.json"
    spec.write_text(document_spec(components=5).to_json())
    at = str(tmp_path)
    inputs = ["--facts", f"{files}/facts", "--details", f"{files}/details"]
    main(["train-features", "--spec", str(spec), *inputs, "--features", f"{at}/train", "--state", f"{at}/state"])
    main(["train-model", "--features", f"{at}/train", "--state", f"{at}/state", "--model", f"{at}/model",
          "--report", f"{at}/report", "--curve", f"{at}/curve", "--mode", "poisson"])
    main(["score-features", *inputs, "--state", f"{at}/state", "--features", f"{at}/score", "--fill", "sentinel"])
    main(
        ["score", "--features", f"{at}/score", "--state", f"{at}/state", "--model", f"{at}/model", "--out", f"{at}/out"]
    )
    assert spark.read.csv(f"{at}/out", header=True).count() == 200


def test_curve_has_a_point_for_every_score(spark, features, tmp_path):
    """More scores than the training summary keeps."""
    many = features.withColumn("copy", F.explode(F.array(*[F.lit(i) for i in range(4)])))
    tables.write_parquet(many.selectExpr("id * 4 + copy as id", "features", "y"), str(tmp_path / "f"))
    rows = tables.read_parquet(spark, str(tmp_path / "f"))
    jobs.train(
        spark,
        str(tmp_path / "f"),
        "y",
        "id",
        str(tmp_path / "m"),
        str(tmp_path / "r"),
        str(tmp_path / "c"),
        mode="none",
    )
    model = artifacts.load_classifier(str(tmp_path / "m"))
    scores = classifier.score(model, rows).select(vector_to_array("probability")[1].alias("p")).distinct().count()
    assert scores == 1200 and spark.read.csv(str(tmp_path / "c"), header=True).count() == scores + 2


def test_commands_for_evaluation_and_held_out_rows(spark, files, tmp_path):
    spec = tmp_path / "spec.json"
    spec.write_text(document_spec(components=None).to_json())
    at = str(tmp_path)
    main(["train-features", "--spec", str(spec), "--facts", f"{files}/facts", "--details", f"{files}/details",
          "--features", f"{at}/train", "--state", f"{at}/state", "--median", "approximate", "--labels-on-driver", "4"])
    main(["train-model", "--features", f"{at}/train", "--state", f"{at}/state", "--model", f"{at}/model", "--report", f"{at}/report",
          "--curve", f"{at}/curve", "--iterations", "3", "--penalty", "0.1", "--elastic-net", "0.5", "--threshold", "0.4",
          "--hold-out", "0.3", "--held-out", f"{at}/held"])
    model = artifacts.load_classifier(f"{at}/model")
    assert (model.getMaxIter(), model.getRegParam(), model.getElasticNetParam(), model.getThreshold()) == (
        3, 0.1, 0.5, 0.4
    )
    held = spark.read.parquet(f"{at}/held")
    assert 30 < held.count() < 90
    kept = {r["label"]: r["value"] for r in spark.read.parquet(f"{at}/report").where("metric = 'rows'").collect()}
    assert sum(kept.values()) + held.count() == 200
    main(["evaluate", "--features", f"{at}/held", "--state", f"{at}/state", "--model", f"{at}/model", "--report", f"{at}/held-report",
          "--curve", f"{at}/held-curve"])
    assert spark.read.parquet(f"{at}/held-report").where("metric = 'accuracy'").count() == 1
    main(["curve-area", "--curve", f"{at}/curve", "--out", f"{at}/area"])
    area = spark.read.parquet(f"{at}/report").where("metric = 'area_under_roc'").first()["value"]
    assert spark.read.parquet(f"{at}/area").first()["area"] == pytest.approx(area)
    with pytest.raises(ValueError, match="go together"):
        jobs.train(spark, f"{at}/train", "toxic", "doc_id", f"{at}/m", f"{at}/r", f"{at}/c", hold_out_share=0.2)


def test_commands_with_folded_rows_and_a_short_curve(spark, features, tmp_path):
    at = str(tmp_path)
    tables.write_parquet(features, f"{at}/f")
    paths = [[f"{at}/{kind}{n}" for kind in "mrc"] for n in range(2)]
    jobs.train(spark, f"{at}/f", "y", "id", *paths[0], max_iter=60, tolerance=1e-10)
    jobs.train(
        spark, f"{at}/f", "y", "id", *paths[1], max_iter=60, tolerance=1e-10, fold=True, curve_points=20
    )
    plain, folded = (artifacts.load_classifier(m) for m, _, _ in paths)
    assert folded.coefficients.toArray() == pytest.approx(plain.coefficients.toArray(), abs=1e-4)
    reports = [{(r["metric"], r["label"]): r["value"] for r in spark.read.parquet(r_).collect()} for _, r_, _ in paths]
    off = reports[1].pop(("curve_area_bound", None))
    assert 0 <= off <= 1 / 17 and set(reports[0]) == set(reports[1])
    exact, short = ({tuple(p) for p in spark.read.csv(c, header=True).collect()} for _, _, c in paths)
    assert len(short) <= 20 < len(exact) and short <= exact
