"""Projection, filling, joining and previewing of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.scalars import log_plus_one
from evenkeel.operators.hot import digest, frequent_keys
from evenkeel.spec import FeatureSpec
from evenkeel.staging import stage

# What stands for a missing number or text in the sentinel policy.
MISSING_NUMBER = -999
MISSING_TEXT = "na"

# Shares that a partition of a join is thought of as: a key with less than one of them is left whole.
SPREAD_FINER = 8

# Partitions at most that rows without a key are spread over.
NULL_SPREAD = 10_000


def rename(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """All columns under new names, by position."""
    return df.toDF(*names)


def log_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``ln(x + 1)`` of the columns on the left under the names on the right."""
    return df.withColumns({new: log_plus_one(old) for old, new in columns.items()})


def fill_sentinel(df: DataFrame) -> DataFrame:
    """Missing numbers (null or NaN) become -999, missing text ``na``; other types stay."""
    return df.fillna(MISSING_NUMBER).fillna(MISSING_TEXT)


def spread_array(df: DataFrame, array: str, names: Sequence[str], *keep: str) -> DataFrame:
    """One double column per array element; null past the end of a short array. A longer array fails the query."""
    values, width = F.col(array), len(names)
    message = F.format_string(f"{array} has %d elements for {width} columns", F.size(values))
    checked = F.when(F.size(values) > width, F.raise_error(message)).otherwise(values)
    # Every column reads the checked array, so the check stays whichever columns are used.
    return df.select(*keep, *[F.get(checked, F.lit(i)).cast("double").alias(name) for i, name in enumerate(names)])


def conform(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The columns of the spec alone, in its types; the label only if present."""
    types = spec.types()
    wanted = [spec.key, *([spec.label] if spec.label in df.columns else []), *spec.inputs]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"input lacks columns: {', '.join(missing)}")
    return df.select(*[F.col(c).cast(types[c]).alias(c) for c in wanted])


def enrich(facts: DataFrame, details: DataFrame, key: str, salts: int = 1) -> DataFrame:
    """Every fact row with the detail columns of its key, null where there are none.

    A key that occurs twice in ``details`` gives two rows; a null key matches nothing, and rows with one are spread over
    the partitions. Spark picks broadcast or sort-merge by size, and splits skewed partitions at run time. ``salts``
    above 1 spreads each key over that many partitions from the start, at the price of as many copies of ``details`` and
    of writing the facts once, which gives repeated rows different and lasting numbers; it is for detail tables too large
    to broadcast with facts piled on few keys.
    """
    if salts > 1:
        facts = stage(facts, "facts")
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
        copies = details.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    else:
        salt = F.lit(0)
        copies = details.withColumn("_salt", _zero(key))
    spread = F.pmod(F.xxhash64(*hashable_columns(facts)), F.lit(NULL_SPREAD)).cast("int") + salts
    return (
        facts.withColumn("_salt", F.when(F.col(key).isNull(), spread).otherwise(salt + _zero(key)))
        .join(copies, on=[key, "_salt"], how="left")
        .drop("_salt")
    )


def enrich_spread(
    facts: DataFrame, details: DataFrame, key: str, parts: int | None = None, finer: int = SPREAD_FINER
) -> DataFrame:
    """As ``enrich``, for facts piled on few keys and details too large to broadcast.

    Keys with at least one in ``parts * finer`` of the facts are found by summaries of the tasks and recounted exactly; each
    is dealt into as many pieces as it has such parts, and only its details are copied, once per piece. All other keys
    are joined as they are. ``parts`` is the number of partitions of the join, by default the session's; facts are read
    three times, so pass a written table.
    """
    parts = parts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = facts.withColumn("_digest", digest(key))
    hot = hot_pieces(keyed, parts, finer)
    piece = F.pmod(F.monotonically_increasing_id(), F.col("_pieces")).cast("int")
    spread = F.pmod(F.xxhash64(*hashable_columns(facts)), F.lit(NULL_SPREAD)).cast("int")
    dealt = keyed.join(F.broadcast(hot), "_digest", "left").withColumn(
        "_salt", F.when(F.col(key).isNull(), spread).otherwise(F.coalesce(piece, _zero(key)))
    )
    copies = spread_details(details, hot, key)
    return dealt.drop("_digest", "_pieces").join(copies, on=[key, "_salt"], how="left").drop("_salt")


def hot_pieces(keyed: DataFrame, parts: int, finer: int = SPREAD_FINER) -> DataFrame:
    """``(_digest, _pieces)`` of the keys with at least one in ``parts * finer`` of the rows, so of as many at most."""
    shares = parts * finer
    total = keyed.where(F.col("_digest").isNotNull()).count()
    pieces = F.ceil(F.col("n") * F.lit(shares) / F.lit(max(1, total))).cast("int")
    return stage(frequent_keys(keyed, "_digest", shares).select("_digest", pieces.alias("_pieces")), "hot-keys").limit(shares)


def spread_details(details: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Details with ``_salt``: those of hot keys once per piece, all others once."""
    marked = details.withColumn("_digest", digest(key)).join(F.broadcast(hot), "_digest", "left")
    last = F.coalesce("_pieces", F.lit(1)) - 1
    return marked.withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_digest", "_pieces")


def _zero(key: str) -> Column:
    """Always 0, but not a constant the optimizer would take out of the join key."""
    return F.pmod(F.hash(key), F.lit(1)).cast("int")


def preview(df: DataFrame, order_by: str, rows: int = 5) -> DataFrame:
    """The first rows by a column; ties at the cut are broken by Spark."""
    return df.orderBy(order_by).limit(rows)


def hashable_columns(df: DataFrame) -> list[str]:
    """Columns of simple types, for a hash of the row."""
    simple = {"string", "bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date",
              "timestamp", "timestamp_ntz", "binary"}
    return [name for name, kind in df.dtypes if kind in simple or kind.startswith("decimal")]
