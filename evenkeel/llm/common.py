"""What several operators of this package share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenkeel.staging import stage

ROOT = str(Path(__file__).resolve().parents[2])

#: Words of a text: runs of anything but the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster without a shared copy of the code, pass it with ``--py-files`` instead.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shares(rows: int, per_group: int) -> int:
    """How many groups keep the expected group at ``per_group`` rows or less."""
    return max(1, -(-rows // per_group))


#: More tasks than this gain nothing; groups beyond it share tasks.
MOST_TASKS = 20_000


def by_group(df: DataFrame, groups: int, *keys: str) -> DataFrame:
    """Rows laid out for one task per group, as near as hashing comes: Spark would merge small partitions by their bytes,
    though the work on a group may be far more than its rows weigh."""
    return df.repartition(max(1, min(int(groups), MOST_TASKS)), *keys)


def numbered(df: DataFrame, name: str, *columns: Column) -> DataFrame:
    """``(row, item, *columns)``: a written table with a distinct number in each row, the row itself as a struct, so that
    its names clash with nothing, and ``columns`` of ``df``.

    The number is written, so every later scan has the same, however Spark cuts the files by then.
    """
    number = F.monotonically_increasing_id().alias("row")
    return stage(df.select(number, F.struct("*").alias("item"), *columns), name)


def identified(documents: DataFrame) -> DataFrame:
    """``(file, at, item)``: each row as a struct, so that its names clash with nothing, and where it lies: a digest of its
    Parquet file's path and its place there. Every scan tells the same, however Spark cuts the files by then.

    Rows that do not come straight from Parquet files are written to some first.
    """

    def marked(rows: DataFrame) -> DataFrame:
        origin = rows.metadataColumn("_metadata")
        file = F.unhex(F.md5(origin["file_path"])).alias("file")
        return rows.select(file, origin["row_index"].alias("at"), F.struct("*").alias("item"))

    try:
        return marked(documents)
    except AnalysisException:
        return marked(stage(documents, "identified"))


def dealt(number: str | Column, groups: int) -> Column:
    """A group for a row number: groups are even, whatever the rows hold."""
    return F.pmod(F.xxhash64(number), F.lit(groups)).cast("int")


def crc32_of_key(key: str) -> Column:
    """CRC-32 of the key as text; null keys count as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


#: A key with one part in this many of all rows is hot; there can be at most as many such keys.
HOT_PARTS = 1000


def attach(
    rows: DataFrame, lookup: DataFrame, key: str, copies: str, total: int, keep_copies: bool = False
) -> DataFrame:
    """Rows with the columns of their key in ``lookup`` (unique by key), null where it has none.

    ``lookup`` says in ``copies`` how many of the ``total`` rows hold the key. Hot keys are at most ``HOT_PARTS`` by
    that count, so they are broadcast; the others are joined by a shuffle in which no key weighs much.
    ``rows`` is read twice: pass a written table.
    """
    values = [c for c in lookup.columns if c != key and (keep_copies or c != copies)]
    is_hot = F.col(copies) * HOT_PARTS >= F.lit(total)
    hot = lookup.where(is_hot).select(key, *values).limit(HOT_PARTS)
    cold = lookup.where(~is_hot).select(key, *values)
    with_hot = rows.join(F.broadcast(hot), key, "inner")
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, "left")
    return with_hot.unionByName(others)


def slots(rows: DataFrame, group: str, order: list[str], name: str = "slot") -> DataFrame:
    """Rows numbered without gaps from 0 within each ``group``, as a long column ``name``.

    Each partition numbers its own rows of a group; what comes before it is known from one count per partition and
    group. So a group that holds most of the table is numbered by many tasks. Rows that tie in ``order`` may swap.
    """
    parts = stage(rows.withColumn("_part", F.spark_partition_id()), "slots")
    counts = parts.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        F.col("_part").alias("_of"),
        F.col(group).alias("_in"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    own = F.row_number().over(Window.partitionBy("_part", group).orderBy(*order)) - 1
    same = (F.col("_part") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_in"))
    found = parts.withColumn("_own", own).join(before, same)
    return found.select(*rows.columns, (F.col("_before") + F.col("_own")).alias(name))
