"""Staged tables: where they are written and when they go."""

from __future__ import annotations

import subprocess
import sys
import time
from pathlib import Path

import pytest

from evenkeel import staging
from evenkeel.operators import balance, categories, metrics, roc


class Session:
    """The parts of a session that decide where to stage."""

    def __init__(self, folder, master, warehouse="file:/somewhere/warehouse"):
        self.conf = {"spark.sql.warehouse.dir": warehouse} | ({"spark.checkpoint.dir": folder} if folder else {})
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})


def files_below(folder):
    return [p for p in Path(folder.removeprefix("file:")).rglob("*") if p.is_file()]


def test_folder_comes_from_the_session():
    assert staging.scratch_root(Session("hdfs://shared/scratch/", "yarn")) == "hdfs://shared/scratch"
    assert staging.scratch_root(Session(None, "yarn", "hdfs://n/warehouse/")) == "hdfs://n/warehouse/_scratch"
    assert staging.scratch_root(Session(None, "local[2]")) == "file:/somewhere/warehouse/_scratch"


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.scratch_root(Session(None, "spark://host:7077"))


def test_staged_table_is_gone_after_use(spark):
    with staging.staged(spark.range(10), "numbers") as table:
        (file,) = {str(Path(f.removeprefix("file:")).parent) for f in table.inputFiles()}
        assert table.count() == 10 and Path(file.replace("//", "/")).is_dir()
    assert not Path(file).exists()


def test_staged_table_is_gone_after_an_error(spark):
    with pytest.raises(ZeroDivisionError), staging.staged(spark.range(10), "numbers") as table:
        file = Path(table.inputFiles()[0].removeprefix("file:")).parent
        raise ZeroDivisionError
    assert not file.exists()


def test_nothing_is_left_of_index_map_curve_and_metrics(spark):
    scored = spark.range(100).selectExpr(
        "id", "cast(id % 2 as int) as label", "id / 100.0d as score", "1.0d as prediction"
    )
    with staging.scratch(spark):
        folder = staging.scratch_folder(spark)
        assert categories.index_map(categories.category_counts(scored, ["label"])).count() == 2
        assert roc.roc_curve(scored, "label", "score").count() == 102
        assert metrics.metrics_report(scored, "label", "prediction", "score").count() == 12
        assert balance.shuffle_rows(scored, partitions=2).count() == 100
        with staging.scratch(spark):
            assert staging.scratch_folder(spark).startswith(folder) and staging.stage(spark.range(3)).count() == 3
        assert files_below(folder)
    assert not Path(folder.removeprefix("file:")).exists()
    assert folder.startswith(staging.scratch_folder(spark))


def test_folder_of_the_application_goes_with_it(tmp_path):
    code = (
        "from pyspark.sql import SparkSession; from evenkeel.staging import stage, scratch_folder\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.sql.warehouse.dir', 'file:{tmp_path}').getOrCreate()\n"
        "assert stage(s.range(5)).count() == 5; print('at', scratch_folder(s)); s.stop()"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True).stdout
    folder = out.split("at ")[1].strip()
    for _ in range(50):
        if not Path(folder.removeprefix("file:")).exists():
            break
        time.sleep(0.2)
    assert not Path(folder.removeprefix("file:")).exists()


def test_types_survive(spark):
    df = spark.createDataFrame([(1, None, [1.0])], "i int, s string, a array<double>")
    again = staging.stage(df)
    assert again.dtypes == df.dtypes and again.collect() == df.collect()
