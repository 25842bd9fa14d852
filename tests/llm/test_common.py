from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from evenkeel.llm import common
from evenkeel.staging import stage


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


def test_hot_keys_stay_where_they_are(spark, plain_shuffles):
    rows = stage(spark.range(0, 12_000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', concat('k', id div 4)) as k", "id"))
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("copies"), F.max("id").alias("value"))
    out = common.attach(rows, stage(counts), "k", "copies", 12_000)
    assert sorted(out.columns) == ["id", "k", "value"] and out.count() == 12_000
    assert largest_partition(out) < 12_000 / 6
    wrong = out.join(counts.withColumnRenamed("value", "right"), "k").where("value != right")
    assert wrong.count() == 0
    kept = common.attach(rows, stage(counts.where("k != 'hot'")), "k", "copies", 12_000, keep_copies=True)
    assert kept.where("k = 'hot' and value is null and copies is null").count() == 4_000 and kept.count() == 12_000


def test_slots_have_no_gaps(spark, plain_shuffles):
    rows = spark.range(0, 9_000, 1, 8).selectExpr("if(id % 3 = 0, null, int(id % 5 div 4)) as g", "7 as same", "id")
    out = common.slots(rows, "g", ["same"], "nth")
    by = {}
    for r in out.collect():
        by.setdefault(r["g"], []).append(r["nth"])
    assert {g: sorted(n) == list(range(len(n))) for g, n in by.items()} == {0: True, 1: True, None: True}
    assert sum(map(len, by.values())) == 9_000


def test_numbers_and_groups(spark):
    rows = common.numbered(spark.range(5_000).selectExpr("1 as same"), "n")
    groups = Counter(r["g"] for r in rows.select(common.dealt("row", 10).alias("g")).collect())
    assert rows.select("row").distinct().count() == 5_000 and max(groups.values()) < 1_000 and len(groups) == 10
    assert [common.shares(n, 10) for n in (0, 1, 10, 11)] == [1, 1, 1, 2]


def test_checksum_of_keys(spark):
    rows = spark.createDataFrame([(12,), (None,), (-3,)], "doc_id long")
    found = {r["doc_id"]: r["c"] for r in rows.select("doc_id", common.crc32_of_key("doc_id").alias("c")).collect()}
    assert found == {12: zlib.crc32(b"12"), None: 0, -3: zlib.crc32(b"-3")}
