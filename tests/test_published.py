from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from evenkeel.plans.features import FittedFeatures, fit_features
from evenkeel.sources import artifacts, published, tables
from evenkeel.spec import Block, FeatureSpec

SPEC = FeatureSpec("k", "y", amounts=("a",), categories=("c",), blocks=(Block("v", ("v0", "v1")),))


def values(spark, path):
    return sorted(r["id"] for r in published.read_published(spark, path).collect())


def test_one_state_replaces_another(spark, tmp_path):
    path = str(tmp_path / "t")
    first = published.publish_parquet(spark.range(5), path)
    assert first.rows == {"": 5} and values(spark, path) == list(range(5))
    second = published.publish_parquet(spark.range(10, 13), path)
    assert published.published(spark, path) == second and values(spark, path) == [10, 11, 12]
    assert not Path(first.folder).exists()
    names = {p.name for p in tmp_path.joinpath("t").iterdir() if not p.name.startswith(".")}
    assert names == {Path(second.folder).name, "_current"}


def test_plain_folders_are_read_and_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).write.parquet(path)
    assert values(spark, path) == [0, 1, 2, 3] and published.published(spark, path) is None
    published.publish_parquet(spark.range(2), path)
    assert values(spark, path) == [0, 1]


@pytest.mark.parametrize("moment", ["half-way", "before the manifest", "before the switch"])
def test_a_writer_that_dies_leaves_the_old_state(spark, tmp_path, monkeypatch, moment):
    path = str(tmp_path / "t")
    published.publish_parquet(spark.range(5), path)

    def die(*_):
        raise OSError("killed")

    def write(folder):
        spark.range(100).write.parquet(folder)
        if moment == "half-way":
            next(Path(folder).glob("*.parquet")).unlink()
            die()

    if moment == "before the manifest":
        monkeypatch.setattr(published._Files, "write", die)
    if moment == "before the switch":
        monkeypatch.setattr(published._Files, "replace", die)
    with pytest.raises(OSError, match="killed"):
        published.publish(spark, path, write, tables=("",))
    monkeypatch.undo()
    assert values(spark, path) == list(range(5))
    published.publish_parquet(spark.range(3), path)
    assert values(spark, path) == [0, 1, 2] and len(list(tmp_path.joinpath("t").glob("version-*"))) == 1


def test_missing_files_are_told(spark, tmp_path):
    path = str(tmp_path / "t")
    state = published.publish_parquet(spark.range(5), path)
    next(Path(state.folder).glob("*.parquet")).unlink()
    with pytest.raises(ValueError, match="lacks 1 files"):
        published.read_published(spark, path)


def test_fitted_state_is_whole_or_the_old_one(spark, tmp_path, monkeypatch):
    data = spark.range(40).selectExpr("id as k", "int(id % 2) as y", "double(id) as a", "concat('c', id % 3) as c", "double(id) as v0", "double(-id) as v1")
    path = str(tmp_path / "state")
    fit_features(data.where("k < 20"), SPEC).save(path)
    before = FittedFeatures.load(spark, path).numeric.collect()
    fitted = fit_features(data, SPEC)
    monkeypatch.setattr(fitted, "numeric", None)  # the third of four parts fails
    with pytest.raises(AttributeError):
        fitted.save(path)
    loaded = FittedFeatures.load(spark, path)
    assert loaded.numeric.collect() == before and loaded.feature_table(data).count() == 40
    fit_features(data, SPEC).save(path)
    assert FittedFeatures.load(spark, path).numeric.collect() != before


def test_models_and_tables_follow(spark, tmp_path):
    points = spark.createDataFrame([(Vectors.dense([float(i)]), float(i > 4)) for i in range(10)], ["features", "label"])
    path = str(tmp_path / "m")
    for limit in (3, 10):
        model = LogisticRegression(maxIter=limit, regParam=0.1).fit(points)
        artifacts.save_model(model, path)
        assert artifacts.load_classifier(path).intercept == model.intercept
    published.publish_parquet(points, str(tmp_path / "f"))
    assert tables.read_parquet(spark, str(tmp_path / "f")).count() == 10
