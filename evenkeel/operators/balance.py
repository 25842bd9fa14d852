"""Class counts and class balancing for a 0/1 label."""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.scalars import unit_interval
from evenkeel.operators.ordered import running_totals
from evenkeel.operators.rows import hashable_columns
from evenkeel.staging import stage

# Fixed value: seed of the resampling.
SEED = 42
#: Means above this are drawn in parts.
LARGEST_MEAN = 16
MODES = ("replicate", "poisson", "weight", "none")


@dataclass(frozen=True)
class ClassBalance:
    """Rows of either class before balancing, and rows without a label, which are left out."""

    positives: int
    negatives: int
    unlabelled: int

    @property
    def ratio(self) -> float:
        return self.negatives / self.positives


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """``(label, n)``, null labels included."""
    return df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """One row ``(positives, negatives, unlabelled, ratio)`` from one scan; the ratio is
    negatives per positive, null without positives."""
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label).isNull()).alias("unlabelled"),
    )
    return counts.withColumn("ratio", F.try_divide(F.col("negatives").cast("double"), F.col("positives")))


def checked_balance(df: DataFrame, label: str) -> ClassBalance:
    """Class sizes on the driver; both classes must be present, and there may be no other label than 0, 1 and null."""
    known = F.col(label).isin(0, 1)
    row = df.agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label).isNull()).alias("unlabelled"),
        F.count_if(~known).alias("others"),
        F.min(F.when(~known, F.col(label))).alias("least"),
        F.max(F.when(~known, F.col(label))).alias("largest"),
    ).first()
    if row["others"]:
        raise ValueError(
            f"{label} must be 0, 1 or null: {row['others']} rows have others, from {row['least']} to {row['largest']}"
        )
    balance = ClassBalance(row["positives"], row["negatives"], row["unlabelled"])
    if not balance.positives or not balance.negatives:
        raise ValueError(
            f"{label} needs both classes: {balance.positives} rows of 1, {balance.negatives} rows of 0, "
            f"{balance.unlabelled} without a label"
        )
    return balance


def split_classes(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Positive and negative rows; rows without a label are in neither."""
    return df.where(F.col(label) == 1), df.where(F.col(label) == 0)


def copies(key: str, ratio: float) -> Column:
    """How often to take a row so that rows are taken ``ratio`` times on average.

    Every row is taken the whole part of the ratio; the rest is decided by the
    key, so the answer is the same on any partitioning and on a re-run task.
    """
    whole = int(ratio)
    extra = F.coalesce(unit_interval(key) < F.lit(ratio - whole), F.lit(False))
    return F.lit(whole) + extra.cast("int")


def hold_out(df: DataFrame, key: str, share: float) -> tuple[DataFrame, DataFrame]:
    """Rows to fit on and rows held out, about ``share`` of them, decided by the key alone.

    Repeatable on any partitioning, and rows of one key stay together. Rows without a key are not held out.
    """
    if not 0 <= share < 1:
        raise ValueError(f"the share held out is from 0 up to 1, not {share}")
    held = F.coalesce(
        unit_interval(F.concat(F.lit("hold-out:"), F.col(key).cast("string"))) < F.lit(float(share)), F.lit(False)
    )
    return df.where(~held), df.where(held)


def oversample_replicate(df: DataFrame, label: str, key: str, ratio: float) -> DataFrame:
    """Negatives once, positives as often as ``copies`` says, in one scan."""
    times = F.when(F.col(label) == 1, copies(key, ratio)).when(F.col(label) == 0, F.lit(1)).otherwise(F.lit(0))
    return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), times))).drop("_copy")


def poisson_copies(key: Column, ratio: float, seed: int = SEED) -> Column:
    """How often a row is drawn when rows are drawn ``ratio`` times on average with replacement: a Poisson number that
    depends on ``key``, as text, and the seed alone.

    A hash of both in [0, 1) is looked up among the distribution's sums. Large ratios are several smaller draws, added.
    """
    draws = max(1, math.ceil(ratio / LARGEST_MEAN))
    sums, term, upto = [], math.exp(-ratio / draws), 0.0
    while upto < 1 - 2.0**-40 and len(sums) < 8 * LARGEST_MEAN:
        upto += term
        sums.append(upto)
        term *= ratio / draws / len(sums)
    table = F.array(*[F.lit(x) for x in sums])
    hashes = [unit_interval(F.concat(F.lit(f"{seed}:{n}:"), key)) for n in range(draws)]
    return functools.reduce(lambda a, b: a + b, [_sums_upto(table, u) for u in hashes])


def _sums_upto(table: Column, value: Column) -> Column:
    return F.size(F.filter(table, lambda x: x <= value))


def oversample_poisson(df: DataFrame, label: str, key: str, ratio: float, seed: int = SEED) -> DataFrame:
    """Negatives once, positives drawn with replacement.

    What is drawn follows from the seed, the key, and the place among rows of the same key, so it is the same on any
    partitioning and in a re-run task. Rows of one key are placed by a hash of their plain columns, in slices, so a key
    of any number of rows is placed by many tasks; a null key is a key.
    """
    positives, negatives = split_classes(df, label)
    text = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    if positives.groupBy(key).count().where("count > 1").isEmpty():
        placed = positives.withColumn("_place", F.lit(0).cast("long"))
    else:
        ranked = positives.select("*", F.xxhash64(*hashable_columns(positives)).alias("_hash"), F.monotonically_increasing_id().alias("_at"))
        placed = running_totals(ranked, ["_hash", "_at"], {"_upto": F.lit(1)}, [key]).withColumn("_place", F.col("_upto") - 1)
    name = F.concat(text, F.lit(":"), F.col("_place").cast("string"))
    drawn = placed.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), poisson_copies(name, ratio, seed))))
    return drawn.select(*df.columns).unionByName(negatives)


def balance_classes(
    df: DataFrame,
    label: str,
    key: str,
    mode: str = "replicate",
    seed: int = SEED,
    allow_undersampling: bool = False,
) -> tuple[DataFrame, ClassBalance]:
    """Rows with both classes about equally strong, and the class sizes before.

    ``replicate`` copies positives by key, ``poisson`` draws them with replacement,
    ``weight`` adds a ``weight`` column instead of rows, ``none`` only drops rows
    without a label. With more positives than negatives the same rules would
    thin out the positives, which must be asked for.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}, not {mode!r}")
    sizes = checked_balance(df, label)
    if mode == "none":
        return df.where(F.col(label).isin(0, 1)), sizes
    if mode == "weight":
        weight = F.when(F.col(label) == 1, F.lit(sizes.ratio)).otherwise(F.lit(1.0))
        return df.where(F.col(label).isin(0, 1)).withColumn("weight", weight), sizes
    if sizes.ratio < 1 and not allow_undersampling:
        raise ValueError(
            f"{sizes.positives} positives outnumber {sizes.negatives} negatives; "
            "pass allow_undersampling=True to thin them out"
        )
    if mode == "poisson":
        return oversample_poisson(df, label, key, sizes.ratio, seed), sizes
    return oversample_replicate(df, label, key, sizes.ratio), sizes


def shuffle_rows(df: DataFrame, seed: int = SEED, partitions: int | None = None) -> DataFrame:
    """Rows in random order, in ``partitions`` partitions if given; all of them take part in the sort.

    The random numbers are written with the rows, so a re-run task finds the same order. This sorts the whole table; a
    full-batch fit does not need it.
    """
    drawn = stage(df.withColumn("_draw", F.rand(seed)), "shuffle")
    if partitions is None:
        return drawn.orderBy("_draw").drop("_draw")
    return drawn.repartitionByRange(partitions, "_draw").sortWithinPartitions("_draw").drop("_draw")


def fold_rows(rows: DataFrame, label: str, features: str = "features", weight: str | None = None) -> DataFrame:
    """``(features, label, weight)``: rows equal in features and label as one row that weighs what they do together.

    Vectors are compared as they are stored, so a sparse and a dense one of the same values stay apart, which changes no
    sum. Equal rows are added up inside each task first: a vector that a third of the rows share is one row per task.
    Rows without a label or a vector go.
    """
    times = F.lit(1.0) if weight is None else F.col(weight)
    known = rows.where(F.col(label).isNotNull() & F.col(features).isNotNull())
    return known.groupBy(features, label).agg(F.sum(times).cast("double").alias("weight"))
