"""Ranges, medians, scaling and covariance on edge columns, also against Spark ML's own fit."""

from __future__ import annotations

import struct

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import PCA, Imputer, MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from evenkeel.functions.scalars import ordered_bits
from evenkeel.operators import numeric

NAN = float("nan")
LINEITEM = "/root/testdata/sf0.01/lineitem.parquet"
MONEY = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def frame(spark, *columns, kind="double"):
    names = [f"x{i}" for i in range(len(columns))]
    return spark.createDataFrame(list(zip(*columns, strict=True)), ", ".join(f"{n} {kind}" for n in names))


def medians(df):
    return numeric.as_dict(numeric.exact_medians(df, df.columns), "median")


def test_median_ignores_null_and_nan(spark):
    df = frame(spark, [1.0, 2.0, None, 4.0, NAN], [None] * 5, [5.0] * 5)
    assert medians(df) == {"x0": 2.0, "x1": None, "x2": 5.0}
    assert numeric.as_dict(numeric.approximate_medians(df, df.columns), "median") == medians(df)


def test_median_of_even_count_is_the_lower(spark):
    assert medians(frame(spark, [7, None, 1, 2, 3], kind="int")) == {"x0": 2.0}


def test_exact_medians_equal_the_imputer_without_error(spark):
    lineitem = spark.read.parquet(LINEITEM)
    fitted = Imputer(inputCols=MONEY, outputCols=[f"{c}_" for c in MONEY], strategy="median", relativeError=0.0)
    expected = fitted.fit(lineitem).surrogateDF.first().asDict()
    assert numeric.as_dict(numeric.exact_medians(lineitem, MONEY), "median") == {c: expected[c] for c in MONEY}


EDGES = [0.0, -0.0, 5e-324, 2.225073858507201e-308, 2.2250738585072014e-308, 1.0, 1.9999999999999998, 2.0, 0.1, 1 / 3,
         2.0**-40, 2.0**1023, 1.7976931348623157e308, float("inf"), 1024.0, 1023.9999999999999, 7.0]


def test_ordered_bits_are_those_of_the_double(spark):
    values = sorted({*EDGES, *(-v for v in EDGES), *(2.0**e for e in range(-1074, 1024, 7))})
    found = spark.createDataFrame([(v,) for v in values], "x double").select("x", ordered_bits("x").alias("code")).collect()
    for row in found:
        (bits,) = struct.unpack("<q", struct.pack("<d", abs(row["x"])))
        assert row["code"] == (-bits if row["x"] < 0 else bits), row
    assert spark.createDataFrame([(None,)], "x double").select(ordered_bits("x").alias("c")).first()["c"] is None


def test_medians_by_bits(spark):
    lineitem = spark.read.parquet(LINEITEM)
    exact = numeric.as_dict(numeric.exact_medians(lineitem, MONEY), "median")
    rows = lineitem.count()
    assert numeric.as_dict(numeric.radix_medians(lineitem.repartition(5), MONEY, 64), "median") == exact
    for bits, near in ((16, 0.07), (32, 1e-6)):
        for row in numeric.radix_medians(lineitem, MONEY, bits).collect():
            assert row["rows"] == rows and row["median"] == pytest.approx(exact[row["column"]], rel=near)
            below, upto = lineitem.agg(
                F.count_if(F.col(row["column"]) < row["median"]), F.count_if(F.col(row["column"]) < exact[row["column"]])
            ).first()
            assert row["below"] == below and below <= upto < below + row["inside"]
    with pytest.raises(ValueError, match="16, 32"):
        numeric.radix_medians(lineitem, MONEY, 20)


def test_medians_by_bits_of_signs_and_nothing(spark):
    df = frame(spark, [-3.0, -0.0, 0.0, 2.0], [float("-inf"), -5e-324, float("inf"), NAN], [None] * 4, [-7.0, -7.0, -7.0, 1e300])
    found = numeric.radix_medians(df, df.columns, 64)
    assert [tuple(r)[1:] for r in found.orderBy("column").collect()] == [
        (0.0, 4, 1, 2), (-5e-324, 3, 1, 1), (None, 0, 0, 0), (-7.0, 4, 0, 3)
    ]
    assert [r["rows"] for r in numeric.radix_medians(df.limit(0), df.columns).collect()] == [0] * 4


def test_bits_of_an_array_are_those_of_the_column(spark):
    values = [*EDGES, *(-v for v in EDGES)]
    found = spark.createDataFrame([(v,) for v in values], "x double").select(ordered_bits("x").alias("code")).collect()
    assert numeric.bits_in_order(np.array(values)).tolist() == [r["code"] for r in found]


@pytest.mark.parametrize("held", [1_000_000, 1])
def test_tasks_count_leading_bits_themselves(spark, monkeypatch, held):
    """Also when a task hands on its counts after each batch; no logarithm and no row per value leaves Spark's scan."""
    monkeypatch.setattr(numeric, "HELD_COUNTS", held)
    df = spark.range(0, 60_000, 1, 2).selectExpr(
        "cast(id % 700 - 300 as double) / 7 as x0", "if(id % 3 = 0, null, if(id % 5 = 0, double('NaN'), double(id))) as x1"
    )
    for shift, within in ((48, None), (32, {1: 20_000.0})):
        prefixes = within and {p: struct.unpack("<q", struct.pack("<d", v))[0] >> shift + 16 for p, v in within.items()}
        counts = numeric._leading_counts(df, shift, prefixes)
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "LOG" not in plan.upper() and "Generate" not in plan and plan.count("Exchange") == 1
        expected = {}
        for place, name in enumerate(df.columns):
            for row in df.where(f"{name} is not null and not isnan({name})").select(name, ordered_bits(name)).collect():
                if prefixes is None or prefixes.get(place) == row[1] >> shift + 16:
                    n, least = expected.get((place, row[1] >> shift), (0, float("inf")))
                    expected[place, row[1] >> shift] = n + 1, min(least, row[0])
        assert {(r["place"], r["prefix"]): (r["n"], r["least"]) for r in counts.collect()} == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-3, 3) | st.integers(-1000, 1000), min_size=1, max_size=200))
def test_median_of_any_list(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert medians(df) == {"x": float(sorted(values)[(len(values) - 1) // 2])}


def test_median_with_a_hot_value(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.col("id") - 15000.0).alias("x"))
    expected = sorted(r["x"] for r in df.collect())[14999]
    assert medians(df) == {"x": expected}


def test_ranges(spark):
    df = frame(spark, [1.0, NAN, 3.0, None], [None, NAN, None, None], [5.0] * 4)
    found = {r["column"]: (r["low"], r["high"]) for r in numeric.column_ranges(df, df.columns).collect()}
    assert found == {"x0": (1.0, 3.0), "x1": (None, None), "x2": (5.0, 5.0)}


def test_scaler_constant_and_out_of_range(spark):
    model = numeric.scaler(spark, [(1.0, 3.0), (5.0, 5.0)], "v", "s")
    df = numeric.assemble(frame(spark, [-999.0, 1.0, 3.0], [5.0, 5.0, 6.0]), ["x0", "x1"], "v")
    assert [list(r["s"]) for r in model.transform(df).collect()] == [[-500.0, 0.5], [0.0, 0.5], [1.0, 0.5]]
    ranges = spark.createDataFrame([("x0", 1.0, 3.0), ("x1", 5.0, 5.0)], "column string, low double, high double")
    by_expression = numeric.scale_columns(df, ranges, {"x0": "a", "x1": "b"})
    assert [(r["a"], r["b"]) for r in by_expression.collect()] == [(-500.0, 0.5), (0.0, 0.5), (1.0, 0.5)]


def test_scaler_equals_spark_fit(spark):
    vectors = numeric.assemble(spark.read.parquet(LINEITEM), MONEY, "v")
    own = MinMaxScaler(inputCol="v", outputCol="s").fit(vectors)
    found = {r["column"]: (r["low"], r["high"]) for r in numeric.column_ranges(vectors, MONEY).collect()}
    ours = numeric.scaler(spark, [found[c] for c in MONEY], "v", "s")
    assert list(ours.originalMin) == list(own.originalMin) and list(ours.originalMax) == list(own.originalMax)


def test_imputer_keeps_integers(spark):
    df = frame(spark, [7, None, 1, 2, 3], kind="int")
    out = numeric.imputer(spark, medians(df), ["filled"]).transform(df)
    assert dict(out.dtypes)["filled"] == "int"
    assert [r["filled"] for r in out.collect()] == [7, 2, 1, 2, 3]


def test_assemble_policies(spark):
    df = frame(spark, [1.0, None, NAN, 4.0], [1.0, 2.0, 3.0, 4.0])
    assert [list(r["v"]) for r in numeric.assemble(df, df.columns, "v", "skip").collect()] == [[1.0, 1.0], [4.0, 4.0]]
    kept = [list(r["v"]) for r in numeric.assemble(df, df.columns, "v", "keep").collect()]
    assert np.isnan(kept[1][0]) and np.isnan(kept[2][0]) and kept[3] == [4.0, 4.0]
    with pytest.raises(Exception, match="(?i)null|nan"):
        numeric.assemble(df, df.columns, "v").collect()
    own = VectorAssembler(inputCols=df.columns, outputCol="v", handleInvalid="skip").transform(df)
    assert own.collect()[0]["v"] == numeric.assemble(df, df.columns, "v", "skip").collect()[0]["v"]


def test_covariance_of_incomplete_rows(spark):
    df = frame(spark, [1.0, 2.0, 4.0, None], [2.0, 1.0, NAN, 5.0])
    found = {(r["row"], r["col"]): r["covariance"] for r in numeric.covariance(df, df.columns).collect()}
    assert found == {("x0", "x0"): 0.5, ("x0", "x1"): -0.5, ("x1", "x0"): -0.5, ("x1", "x1"): 0.5}


def test_covariance_of_a_joined_wide_table(spark):
    from catalog.queries import E, wide_documents

    found = numeric.covariance(wide_documents(spark, "/root/testdata/sf0.001"), E)
    assert found.count() == 64 * 64


def test_covariance_names_columns_without_values(spark):
    with pytest.raises(ValueError, match="without any value: x1"):
        numeric.covariance(frame(spark, [1.0, 2.0], [None, NAN]), ["x0", "x1"])


def test_components_are_orthonormal_eigenvectors_of_the_covariance(spark):
    lineitem = spark.read.parquet(LINEITEM).select(*MONEY)
    matrix = np.zeros((4, 4))
    for r in numeric.covariance(lineitem, MONEY).collect():
        matrix[MONEY.index(r["row"]), MONEY.index(r["col"])] = r["covariance"]
    vectors = numeric.assemble(lineitem, MONEY, "v")
    model = PCA(k=3, inputCol="v", outputCol="p").fit(vectors)
    parts = model.pc.toArray()
    assert np.allclose(parts.T @ parts, np.eye(3), atol=1e-9)
    values = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    assert np.allclose(np.diag(parts.T @ matrix @ parts), values[:3], rtol=1e-6)
    # Applying the model does not subtract the mean.
    row = model.transform(vectors).select(vector_to_array("v").alias("v"), vector_to_array("p").alias("p")).first()
    assert np.allclose(np.array(row["v"]) @ parts, row["p"])


def test_median_outside_its_first_bracket(spark, monkeypatch):
    """Brackets that miss the middle are widened until they hold it."""
    real = numeric._quantiles
    monkeypatch.setattr(
        numeric, "_quantiles", lambda s, ranks: {p: [v - 100 for v in q] for p, q in real(s, ranks).items()}
    )
    df = spark.range(999).select(F.col("id").cast("double").alias("x"), F.lit(3.0).alias("y"))
    assert medians(df) == {"x": 499.0, "y": 3.0}


def test_covariance_shuffles_a_row_per_task(spark):
    df = spark.range(1000, numPartitions=6).selectExpr("id * 1.0 as x0", "id % 7 * 1.0 as x1", "id % 3 * 1.0 as x2")
    found = numeric.covariance(df, df.columns)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("MapInPandas") == 4 and "Aggregate" not in plan
    rows = {(r["row"], r["col"]): r["covariance"] for r in found.collect()}
    assert rows["x0", "x1"] == pytest.approx(df.cov("x0", "x1")) and len(rows) == 9


def test_summaries_of_columns_are_merged_apart(spark):
    df = spark.range(1000, numPartitions=6).selectExpr("id * 1.0 as x0", "id % 7 * 1.0 as x1")
    plan = numeric._sketches(df, df.columns, 200)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and plan.count("hashpartitioning(place") == 2
