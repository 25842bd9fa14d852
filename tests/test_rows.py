"""Reading, filling, joining: behaviour on edge rows."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel import Block, FeatureSpec, family
from evenkeel.operators import rows
from evenkeel.presets import card_transactions
from evenkeel.sources import tables


def collected(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_family_names():
    assert family("V", 12, 338)[0] == "V12" and family("V", 12, 338)[-1] == "V338"
    assert len(family("V", 12, 338)) == 327
    assert family("id_", 1, 37, pad=2)[8:10] == ("id_09", "id_10")


def test_card_spec_layout():
    spec = card_transactions()
    assert [(b.name, len(b.columns), b.components) for b in spec.blocks] == [("v", 327, 35), ("c", 13, None)]
    assert len(spec.categories) == 11 and spec.amounts == ("TransactionAmt",)
    assert spec.encoded()[0] == "ProductCD_enc" and spec.indexed()[-1] == "DeviceInfo_idx"
    with_id = card_transactions(with_id_block=True)
    assert [b.output for b in with_id.blocks] == ["v_pca", "id_pca", "c_scaled"]
    assert FeatureSpec.from_json(with_id.to_json()) == with_id


def test_spec_refuses_double_roles_and_too_many_components():
    with pytest.raises(ValueError, match="more than one role: x"):
        FeatureSpec("id", "y", amounts=("x",), categories=("x",))
    with pytest.raises(ValueError, match="3 components from 2 columns"):
        FeatureSpec("id", "y", blocks=(Block("b", ("x1", "x2"), 3),))


def test_join_keeps_unmatched_and_multiplies(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, r string")
    expected = [(None, "c", None), (1, "a", "x"), (1, "a", "y"), (2, "b", None)]
    for salts in (1, 5):
        joined = rows.enrich(left, right, "k", salts=salts)
        assert joined.columns == ["k", "l", "r"]
        assert collected(joined) == expected


@pytest.fixture
def plain_shuffles(spark):
    """Every join by shuffle, into 16 partitions that stay as they are."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def largest_partition(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_salted_join_spreads_a_hot_key(spark, plain_shuffles):
    left = spark.range(8000).select(F.lit(7).alias("k"), (F.col("id") % 2).alias("id"))  # two distinct rows
    right = spark.createDataFrame([(7, "x")], "k int, r string")
    joined = rows.enrich(left, right, "k", salts=32)
    assert joined.where(F.col("r") == "x").count() == 8000
    assert largest_partition(joined) < 8000 / 4


@pytest.mark.parametrize("salts", [1, 4])
def test_join_spreads_rows_without_a_key(spark, plain_shuffles, salts):
    left = spark.range(8000).select(F.when(F.col("id") % 4 == 0, F.col("id")).alias("k"), "id")
    right = spark.range(0, 8000, 8).select(F.col("id").alias("k"), F.lit("x").alias("r"))
    joined = rows.enrich(left, right, "k", salts=salts)
    assert joined.count() == 8000 and joined.where("r = 'x'").count() == 1000
    assert largest_partition(joined) < 8000 / 8


def test_longer_arrays_fail(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0, 3.0])], "id int, v array<double>")
    short = rows.spread_array(df.where("id = 1"), "v", ["a", "b"], "id")
    assert collected(short) == [(1, 1.0, None)]
    for columns in (["a", "b"], ["b"]):
        with pytest.raises(Exception, match="v has 3 elements for 2 columns"):
            rows.spread_array(df, "v", ["a", "b"], "id").select(*columns).collect()


AWKWARD = ["a", " a", "a ", "", "null", None, 'say "hi" now', 'x"y,z', '"', '""', "line\nbreak", "cr\rhere", "crlf\r\nx", "tab\tq",
           "\\", '\\"q', "#c", "é,ü", "\n", "\r", "-", "'", ",", "end\"", '"start', "NaN", "\ufeffx"]


def test_csv_keeps_every_text(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, t, i / 2 if i % 3 else None, t) for i, t in enumerate(AWKWARD)], "id long, t string, x double, u string"
    )
    tables.write_csv(df, str(tmp_path / "out"))
    types = {"id": T.LongType(), "x": T.DoubleType()}
    again = tables.read_csv(spark, str(tmp_path / "out"), types, multi_line=True)
    assert again.dtypes == df.dtypes and collected(again, "id") == collected(df, "id")
    one_line = df.where(~F.coalesce(F.col("t").rlike("[\\r\\n]"), F.lit(False)))
    tables.write_csv(one_line, str(tmp_path / "lines"))
    assert collected(tables.read_csv(spark, str(tmp_path / "lines"), types), "id") == collected(one_line, "id")


def test_spark_splits_a_hot_key_of_the_join(spark):
    """A third of the facts share one key; no detail broadcast, partitions counted as large from 64 kB."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in settings}
    facts = spark.range(60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.sha2(
            F.col("id").cast("string"), 256
        )
    )
    details = spark.range(60000).select(F.col("id").alias("k"), F.lit("d").alias("d"))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        joined = rows.enrich(facts, details, "k")
        assert joined.agg(F.count("*"), F.count("d")).first()[:] == (60000, 60000)
        out = rows.enrich(facts, details, "k")
        assert len(out.collect()) == 60000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_fill_types(spark):
    day = datetime.date(2020, 1, 1)
    df = spark.createDataFrame(
        [(1, 1.5, "a", True, day), (None, None, None, None, None), (2, float("nan"), "", False, day)],
        "i int, x double, s string, b boolean, d date",
    )
    assert collected(rows.fill_sentinel(df), "i") == [
        (-999, -999.0, "na", None, None), (1, 1.5, "a", True, day), (2, -999.0, "", False, day),
    ]


def test_log_of_nonpositive_is_null(spark):
    df = spark.createDataFrame([(-999.0,), (-1.0,), (0.0,), (None,)], "x double")
    assert [r["y"] for r in rows.log_columns(df, {"x": "y"}).collect()] == [None, None, 0.0, None]


def test_csv_types_follow_names_not_values(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    (tmp_path / "in.csv").write_text("id,card,x\n1,10,1.5\n2,,\n3,7.0,2\n")
    df = tables.read_csv(spark, path, {"x": T.DoubleType(), "id": T.LongType(), "absent": T.LongType()})
    assert df.dtypes == [("id", "bigint"), ("card", "string"), ("x", "double")]
    assert collected(df, "id") == [(1, "10", 1.5), (2, None, None), (3, "7.0", 2.0)]


def test_csv_with_wrong_value_fails_unless_permitted(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,x\n1,oops\n")
    types = {"id": T.LongType(), "x": T.DoubleType()}
    with pytest.raises(Exception, match="(?i)malformed|oops"):
        tables.read_csv(spark, str(tmp_path / "in.csv"), types).collect()
    permitted = tables.read_csv(spark, str(tmp_path / "in.csv"), types, malformed="PERMISSIVE")
    assert collected(permitted) == [(1, None)]


def test_csv_single_file(spark, tmp_path):
    path = tmp_path / "out"
    tables.write_csv(spark.range(100).repartition(4), str(path), files=1)
    files = list(path.glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[0] == "id"


def test_conform_names_missing_columns(spark):
    spec = FeatureSpec("id", "y", amounts=("amount",), categories=("kind",))
    with pytest.raises(ValueError, match="lacks columns: amount, kind"):
        rows.conform(spark.range(1), spec)


def test_label_filter_and_columns_reach_the_scan(spark):
    from evenkeel.operators.balance import split_classes

    labels = tables.read_parquet(spark, "/root/testdata/sf0.001/labels.parquet")
    positives, _ = split_classes(labels, "toxic")
    plan = positives.select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(toxic,1)" in plan
    assert "quality" not in plan
