"""Fitting and applying the feature stages."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, Imputer, MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from catalog.queries import E, document_spec, wide_documents
from evenkeel.operators.categories import LabelSize
from evenkeel.plans.features import FittedFeatures, _too_many, fit_features
from evenkeel.presets import card_transactions
from evenkeel.spec import Block, FeatureSpec

SF = "/root/testdata/sf0.001"
SMALL = FeatureSpec("id", "y", amounts=("a",), categories=("c",), blocks=(Block("b", ("x", "z")),), key_type="int")
COLUMNS = "id int, y int, a double, c string, x double, z double"


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [(1, 0, 1.0, "p", 1.0, 5.0), (2, 1, 2.0, "q", None, 5.0), (3, None, 3.0, "p", 3.0, float("nan"))], COLUMNS
    )


def features(df):
    return {r["id"]: r["features"].toArray().round(9).tolist() for r in df.select("id", "features").collect()}


def test_layout(small):
    found = features(fit_features(small, SMALL).transform(small))
    assert found == {
        1: [round(np.log(2), 9), 0.0, 0.5, 1.0, 0.0, 0.0],
        2: [round(np.log(3), 9), 0.0, 0.5, 0.0, 1.0, 0.0],
        3: [round(np.log(4), 9), 1.0, 0.5, 1.0, 0.0, 0.0],
    }


def test_feature_table_has_the_label_only_if_present(small):
    fitted = fit_features(small, SMALL)
    assert fitted.feature_table(small).columns == ["id", "features", "y"]
    assert fitted.feature_table(small.drop("y")).columns == ["id", "features"]


def test_missing_values_when_scoring(spark, small):
    fitted = fit_features(small, SMALL)
    new = spark.createDataFrame([(9, 0.0, None, None, 5.0)], "id int, a double, c string, x double, z double")
    assert features(fitted.transform(new)) == {9: [0.0, 0.0, 0.5, 0.0, 0.0, 1.0]}
    assert features(fitted.transform(new, fill="sentinel")) == {9: [0.0, -500.0, 0.5, 0.0, 0.0, 1.0]}
    with pytest.raises(ValueError, match="fill is one of"):
        fitted.transform(new, fill="zero")


def test_save_and_load(small, tmp_path, spark):
    fitted = fit_features(small, SMALL, labels_on_driver=0)
    fitted.save(str(tmp_path / "state"))
    fitted.save(str(tmp_path / "state"))
    loaded = FittedFeatures.load(spark, str(tmp_path / "state"))
    assert loaded.spec == SMALL and loaded.joined == fitted.joined and list(loaded.joined) == [
        "c"
    ] and loaded.before_join == fitted.before_join
    assert features(loaded.transform(small)) == features(fitted.transform(small))
    state = {r["column"]: (r["low"], r["high"], r["median"]) for r in loaded.numeric.collect()}
    assert state == {"x": (1.0, 3.0, 1.0), "z": (5.0, 5.0, 5.0)}


def test_amounts_without_logarithm(spark, small):
    bad = small.unionByName(spark.createDataFrame([(4, 0, -1.0, "p", 1.0, 5.0), (5, 0, None, "p", 1.0, 5.0)], COLUMNS))
    with pytest.raises(ValueError, match=r"a \(2 rows\)"):
        fit_features(bad, SMALL)
    far = bad.withColumn("x", F.when(F.col("id") == 4, -50.0).otherwise(F.col("x")))
    skipping = fit_features(far, SMALL, on_invalid="skip")
    assert features(skipping.transform(far)) == features(fit_features(small, SMALL).transform(small))
    kept = features(fit_features(bad, SMALL, on_invalid="keep").transform(bad))
    assert len(kept) == 5 and np.isnan(kept[4][0])
    with pytest.raises(Exception, match="(?i)null|nan"):
        fit_features(small, SMALL).transform(bad).select("features").collect()


def test_columns_without_any_value(spark, small):
    empty = small.withColumn("x", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="without any value: x"):
        fit_features(empty, SMALL)
    fitted = fit_features(empty, SMALL, drop_empty=True)
    assert fitted.spec.block_columns == ("z",)
    assert len(features(fitted.transform(empty))[1]) == 5


def test_unknown_options(small):
    with pytest.raises(ValueError, match="on_invalid"):
        fit_features(small, SMALL, on_invalid="drop")
    with pytest.raises(ValueError, match="median"):
        fit_features(small, SMALL, median="mean")


def test_same_features_as_stages_fitted_one_by_one(spark):
    """All statistics from shared passes, against every Spark ML estimator fitted on the data."""
    data = wide_documents(spark, SF).withColumn("amount", F.log(F.col("n_chars") + 1))
    filled = [f"{c}_nan" for c in E]
    categories = ["lang", "source"]
    stages = [VectorAssembler(inputCols=["amount"], outputCol="num_cols")]
    stages += [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in categories]
    stages += [
        Imputer(inputCols=["lang_idx", "source_idx"], outputCols=["lang_nan", "source_nan"], strategy="median"),
        OneHotEncoder(
            inputCols=["lang_nan", "source_nan"], outputCols=["lang_enc", "source_enc"], handleInvalid="keep"
        ),
        Imputer(inputCols=list(E), outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=filled, outputCol="e_cols", handleInvalid="error"),
        MinMaxScaler(inputCol="e_cols", outputCol="e_scaled"),
        PCA(k=12, inputCol="e_scaled", outputCol="e_pca"),
        VectorAssembler(inputCols=["num_cols", "e_pca", "lang_enc", "source_enc"], outputCol="features"),
    ]
    expected = {
        r["doc_id"]: r["features"].toArray() for r in Pipeline(stages=stages).fit(data).transform(data).collect()
    }
    fitted = fit_features(data, document_spec(), compat=True)
    found = {r["doc_id"]: r["features"].toArray() for r in fitted.feature_table(data).collect()}
    assert found.keys() == expected.keys()
    for key, vector in expected.items():
        # The sign of a component is arbitrary.
        assert np.allclose(np.abs(found[key][1:13]), np.abs(vector[1:13]), atol=1e-6)
        assert np.allclose(np.delete(found[key], range(1, 13)), np.delete(vector, range(1, 13)), atol=1e-9)


def test_training_features_are_scaled_and_one_hot(spark):
    data = wide_documents(spark, SF)
    rows = fit_features(data, document_spec(components=None)).transform(data).select("e_scaled", "lang_enc").collect()
    block = np.array([r["e_scaled"].toArray() for r in rows])
    assert block.min() == 0.0 and block.max() == 1.0
    assert all(r["lang_enc"].toArray().sum() == 1.0 for r in rows)


def test_full_width_transactions(spark):
    """The published layout at full width: 1 + 35 + 13 columns, then the category blocks."""
    spec = card_transactions()
    numbers = [((F.xxhash64("id", F.lit(c)) % 1000) / 10).alias(c) for c in spec.block_columns]
    sparse = [F.when(F.xxhash64(F.lit(c), "id") % 5 != 0, n).alias(c) for c, n in zip(spec.block_columns, numbers)]
    kinds = [F.concat(F.lit("k"), F.col("id") % (i + 2)).alias(c) for i, c in enumerate(spec.categories)]
    data = spark.range(400).select(
        F.col("id").alias("TransactionID"), (F.col("id") % 10 == 0).cast("int").alias("isFraud"),
        (F.col("id") / 7).alias("TransactionAmt"), *kinds, *sparse,
    )
    fitted = fit_features(data, spec)
    table = fitted.feature_table(data).collect()
    assert len(table) == 400
    assert {r["features"].size for r in table} == {49 + sum(i + 3 for i in range(11))}


def test_transform_starts_no_job(small, spark):
    fitted = fit_features(small, SMALL, labels_on_driver=0)
    context = spark.sparkContext
    context.setJobGroup("transform", "")
    fitted.transform(small)
    fitted.feature_table(small, fill="sentinel")
    assert not context.statusTracker().getJobIdsForGroup("transform")
    context.setLocalProperty("spark.jobGroup.id", None)


def test_labels_on_the_driver_are_bounded_by_their_sum():
    sizes = {"a": LabelSize(60, 600), "b": LabelSize(30, 300), "c": LabelSize(30, 310), "d": LabelSize(1, 10)}
    assert list(_too_many(sizes, 61)) == ["a"]
    assert list(_too_many(sizes, 60)) == ["a", "c"]
    assert list(_too_many(sizes, 1000)) == []
    assert list(_too_many({"long": LabelSize(1, 1 << 30), "short": LabelSize(5, 5)}, 1000)) == ["long"]
