"""Category indexing and one-hot blocks, also against Spark ML's own fit."""

from __future__ import annotations

import pytest
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

from evenkeel.operators import categories
from evenkeel.plans.features import fit_features
from evenkeel.spec import FeatureSpec

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"


def frame(spark, values, kind="string"):
    return spark.createDataFrame(list(enumerate(values)), f"id int, c {kind}")


def indices(spark, labels, values):
    out = categories.apply_index(frame(spark, values), labels, "c", "i")
    return [r["i"] for r in out.orderBy("id").collect()]


def test_null_and_unseen_share_the_last_index(spark):
    labels = categories.index_map(categories.category_counts(frame(spark, ["b", "b", "a", "a", "c", None]), ["c"]))
    assert [tuple(r) for r in labels.orderBy("index").collect()] == [
        ("c", "a", 2, 0), ("c", "b", 2, 1), ("c", "c", 1, 2),
    ]
    assert indices(spark, labels, ["zz", None, "a"]) == [3.0, 3.0, 0.0]
    (model,) = categories.indexers(labels, ["c"])
    out = model.transform(frame(spark, ["zz", None, "a"])).orderBy("id").collect()
    assert [r["c_idx"] for r in out] == [3.0, 3.0, 0.0]


def test_indexers_keep_columns_of_different_size_apart(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "p string, q string")
    labels = categories.index_map(categories.category_counts(df, ["p", "q"]))
    p, q = categories.indexers(labels, ["p", "q"])
    assert list(p.labels) == ["a", "b", "c"] and list(q.labels) == ["x"]


def test_numbers_are_indexed_by_their_text(spark):
    labels = categories.index_map(categories.category_counts(frame(spark, [10, 9, 10], "int"), ["c"]))
    assert {r["label"]: r["index"] for r in labels.collect()} == {"10": 0, "9": 1}


@pytest.mark.parametrize("column", ["lang", "source"])
def test_same_order_as_string_indexer(spark, column):
    documents = spark.read.parquet(DOCUMENTS)
    labels = categories.index_map(categories.category_counts(documents, [column]))
    ours = [r["label"] for r in labels.orderBy("index").collect()]
    assert ours == list(StringIndexer(inputCol=column, outputCol="i").fit(documents).labels)


def test_broadcast_and_shuffled_join_agree_with_a_hot_value(spark):
    values = ["hot"] * 500 + [f"v{i}" for i in range(300)] + [None] * 400
    labels = categories.index_map(categories.category_counts(frame(spark, values), ["c"]))
    asked = frame(spark, [*values, "new"])
    small, large = (
        categories.apply_index(asked, labels, "c", "i", broadcast_up_to=limit) for limit in (10**6, 0)
    )
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "_spread" in plan.split("Join LeftOuter")[1].split("\n")[0]
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
    assert small.count() == 1201
    assert {r["i"] for r in small.where("c is null or c = 'new'").collect()} == {301.0}


def test_long_labels_are_not_broadcast(spark):
    labels = categories.index_map(categories.category_counts(frame(spark, ["x" * 1000, "é"]), ["c"]))
    size = categories.label_sizes(labels)["c"]
    assert size == categories.LabelSize(2, 1002)
    assert size.within(2) and not size.within(1) and not size.within(10, text_bytes=1001)


def blocks(spark, train, score, **options):
    """Width of the block of column ``c`` and the slot of each scored value."""
    spec = FeatureSpec("id", "y", categories=("c",), key_type="int")
    fitted = fit_features(frame(spark, train), spec, **options)
    rows = fitted.transform(frame(spark, score)).orderBy("id").collect()
    return rows[0]["c_enc"].size, [int(r["c_enc"].indices[0]) if len(r["c_enc"].indices) else None for r in rows]


@pytest.mark.parametrize("on_driver", [100, 0])
def test_block_sizes(spark, on_driver):
    train, full = ["b", "b", "a", "a", "c", None], ["b", "b", "a", "a", "c"]
    score = ["zz", None, "a", "c"]
    limit = {"labels_on_driver": on_driver}
    assert blocks(spark, train, score, **limit) == (4, [3, 3, 0, 2])
    assert blocks(spark, full, score, **limit) == (4, [3, 3, 0, 2])
    assert blocks(spark, train, score, compat=True, **limit) == (4, [3, 3, 0, 2])
    assert blocks(spark, full, score, compat=True, **limit) == (3, [None, None, 0, 2])


def test_compat_equals_indexer_imputer_encoder(spark):
    """The chain of index, median imputer and encoder, fitted by Spark ML on the data itself."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer

    train = frame(spark, ["b", "b", "a", "a", "c", "d", None])
    score = frame(spark, ["a", "d", None, "zz", "b"])
    chain = Pipeline(stages=[
        StringIndexer(inputCol="c", outputCol="c_idx", handleInvalid="keep"),
        Imputer(inputCols=["c_idx"], outputCols=["c_nan"], strategy="median"),
        OneHotEncoder(inputCols=["c_nan"], outputCols=["c_enc"], handleInvalid="keep"),
    ]).fit(train)
    expected = [r["c_enc"] for r in chain.transform(score).orderBy("id").collect()]
    fitted = fit_features(train, FeatureSpec("id", "y", categories=("c",), key_type="int"), compat=True)
    assert [r["c_enc"] for r in fitted.transform(score).orderBy("id").collect()] == expected


def test_column_without_any_value(spark):
    assert blocks(spark, [None, None], ["a", None]) == (1, [0, 0])


def test_counts_are_folded_before_the_shuffle(spark):
    counts = categories.category_counts(spark.read.parquet(DOCUMENTS), ["lang"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("HashAggregate")
    assert plan.count("Exchange") == 1 and "text" not in plan
    assert counts.agg(F.sum("n")).first()[0] == 1000


@pytest.mark.parametrize("hot", ["na", "x" * 5000, "known"])
def test_hot_values_spread(spark, hot):
    """Half of the rows hold one value: unknown, long, or known; no adaptive execution."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name) for name in settings}
    labels = categories.index_map(
        categories.category_counts(frame(spark, ["known", "known", *[f"v{i}" for i in range(500)]]), ["c"])
    )
    asked = spark.range(20_000).selectExpr("id", f"if(id % 2 = 0, '{hot}', concat('v', id % 700)) as c")
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        out = categories.apply_index(asked, labels, "c", "i", broadcast_up_to=0)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 20_000 / 6
        assert {r["i"] for r in out.where(F.col("c") == hot).collect()} == {0.0 if hot == "known" else 501.0}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_known_size_needs_no_job(spark):
    labels = categories.index_map(categories.category_counts(frame(spark, ["a", "b", "a"]), ["c"]))
    spark.sparkContext.setJobGroup("no-jobs", "")
    for limit in (10, 0):
        categories.apply_index(
            frame(spark, ["a"]), labels, "c", "i", broadcast_up_to=limit, size=categories.LabelSize(2, 2)
        )
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("no-jobs")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
