"""CSV and Parquet tables in and out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from evenkeel.sources.published import read_published

#: Every text comes back as it was: blanks are kept, quotes are doubled inside quotes.
EXACT_TEXT = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}

#: Stands for an unquoted empty cell while it is read. A cell of this very text, in private-use characters, would read
#: as null; a quoted empty cell is empty text.
UNQUOTED_EMPTY = "\ue000null\ue000"


def read_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, T.DataType],
    sep: str = ",",
    malformed: str = "FAILFAST",
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header line, typed by column name.

    Only the header is read to learn the order of the columns; types come from
    ``types`` (text for columns it does not name), never from the values, so two
    files cannot disagree. An empty cell is null, a quoted empty one is empty text. A cell that does not fit its type
    fails the read unless ``malformed="PERMISSIVE"`` asks for null. ``multi_line`` is needed for line breaks in
    quoted text; a file then cannot be split among tasks.
    """
    options = {"sep": sep, "header": True, "multiLine": multi_line, "nullValue": UNQUOTED_EMPTY, **EXACT_TEXT}
    header = spark.read.csv(path, **options).columns
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    return spark.read.schema(schema).csv(path, enforceSchema=False, mode=malformed, **options)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A table, or the current version of a published one."""
    return read_published(spark, path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with a header line in each file, written by all tasks.

    Null is an empty cell, empty text a quoted one. ``files=1`` gives a single file, for small results only.
    """
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").csv(path, header=True, **EXACT_TEXT)
