"""Numeric columns: ranges, medians, imputing, scaling, covariance, components."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import Imputer, ImputerModel, MinMaxScaler, MinMaxScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenkeel.functions.scalars import impute, min_max
from evenkeel.operators.ordered import running_totals
from evenkeel.staging import stage

# Size of the quantile summaries, whose rank error is about 0.04 % of the rows, and the shares of the rows to either side
# of the middle that are looked at, one after the other.
SKETCH_SIZE = 8192
BRACKETS = (0.002, 0.02, 0.2)

# Leading bits of a double that an approximate median is told by.
RADIX_BITS = 32

# Counts by leading bits that a task holds before it hands them on.
HELD_COUNTS = 1_000_000

# Counts that weigh as much as the arrays which hold those of one batch and column.
PART_COUNTS = 16

# Summaries and matrices of tasks are merged in so many groups before they meet.
MERGE_GROUPS = 256


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(place, value)``: the values of many columns below each other, without null and NaN.

    Statistics per column are then a plain grouped aggregation: rows are folded inside each task, and
    the columns are divided among the tasks that finish them. An aggregate per column side by
    side would outgrow generated code and end in a single task.
    """
    values = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(F.posexplode(values).alias("place", "value")).where(F.col("value").isNotNull() & ~F.isnan("value"))


def column_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, low, high)`` in one pass, without null and NaN; null for a column that has nothing else."""
    found = long_values(df, columns).groupBy("place").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return _places(df.sparkSession, columns).join(found, on="place", how="left").select("column", "low", "high")


def _sketches(df: DataFrame, columns: Sequence[str], size: int) -> DataFrame:
    """``(place, sketch)``: one mergeable summary of quantiles per column.

    Tasks' summaries are merged in groups first and then per column, so no task merges those of all columns, nor those
    of all tasks.
    """
    values = long_values(df, columns).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    parts = values.groupBy("place", "part").agg(F.kll_sketch_agg_double("value", F.lit(size)).alias("sketch"))
    return parts.groupBy("place").agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def _quantiles(sketches: DataFrame, ranks: Sequence[float]) -> dict[int, list[float]]:
    """Values at the given ranks for each column, on the driver."""
    values = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(r))).alias(f"q{i}") for i, r in enumerate(ranks)]
    return {r["place"]: [r[f"q{i}"] for i in range(len(ranks))] for r in sketches.select("place", *values).collect()}


def radix_medians(df: DataFrame, columns: Sequence[str], bits: int = RADIX_BITS) -> DataFrame:
    """``(column, median, rows, below, inside)``: the lower median as far as the leading ``bits`` of its double tell.

    Values are counted by their leading 16 bits, those that share the middle's are counted by their next 16, and so on:
    one pass for every 16 bits, all columns at once, at most 65,536 counts a column and pass, nothing drawn and nothing
    that depends on partitions. ``median`` is the smallest of the column's own values that share the leading bits with
    the lower median; ``below`` rows are smaller and ``inside`` share them, so it is at most ``inside`` - 1 ranks off,
    and with 32 bits less than a millionth of itself. 64 bits give the lower median. Null and NaN do not count; a column
    that has nothing else has a null median and no rows. Each task counts its own rows before the shuffle.
    """
    if bits not in (16, 32, 48, 64):
        raise ValueError(f"16, 32, 48 or 64 bits, not {bits!r}")
    spark = df.sparkSession
    values = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    found: dict[int, tuple] = {}
    for shift in range(48, 48 - bits, -16):
        if shift != 48 and not found:
            break
        within = None if shift == 48 else {p: state[0] for p, state in found.items()}
        counts = _leading_counts(values, shift, within)
        if shift == 48:
            rank = F.ceil(F.col("all") / 2)
        else:
            known = [(p, rank - below) for p, (_, _, _, below, _, rank) in found.items()]
            # One row per column.
            counts = counts.join(F.broadcast(spark.createDataFrame(known, "place int, rank bigint")), on="place")
            rank = F.col("rank")
        place = Window.partitionBy("place")
        summed = counts.withColumns(
            {"upto": F.sum("n").over(place.orderBy("prefix")), "all": F.sum("n").over(place)}
        ).withColumn("rank", rank)
        middle = summed.where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))).collect()
        before = {p: (state[1], state[3], state[5]) for p, state in found.items()}
        for r in middle:
            rows_, below, rank_ = before.get(r["place"], (r["all"], 0, r["rank"]))
            found[r["place"]] = (r["prefix"], rows_, r["least"], below + r["upto"] - r["n"], r["n"], rank_)
    table = [
        (c, found[i][2], found[i][1], found[i][3], found[i][4]) if i in found else (c, None, 0, 0, 0)
        for i, c in enumerate(columns)
    ]
    return spark.createDataFrame(table, "column string, median double, rows bigint, below bigint, inside bigint")


def bits_in_order(values: np.ndarray) -> np.ndarray:
    """``scalars.ordered_bits`` of an array: the bits of the absolute value, with the value's sign."""
    bits = np.abs(values).view(np.int64)
    return np.where(values < 0, -bits, bits)


def _leading_counts(values: DataFrame, shift: int, within: Mapping[int, int] | None) -> DataFrame:
    """``(place, prefix, n, least)``: rows and smallest value by the bits above ``shift``, per column of doubles.

    ``within`` names per column the 16 bits fewer that values must share to count; other columns are left out. A task
    holds ``HELD_COUNTS`` counts at a time, whatever the number of its rows and columns, and hands on those that are more.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0
        for batch in batches:
            for place, column in enumerate(batch.columns):
                if within is not None and place not in within:
                    continue
                # Null comes as NaN; zero gets one sign.
                found = column.to_numpy(zero_copy_only=False) + 0.0
                if within is None:
                    found = found[~np.isnan(found)]
                else:
                    found = found[~np.isnan(found) & (bits_in_order(found) >> (shift + 16) == within[place])]
                if len(found):
                    found.sort()
                    part = _added(bits_in_order(found) >> shift, np.ones(len(found), np.int64), found)
                    held.setdefault(place, []).append(part)
                    size += len(part[0]) + PART_COUNTS
            if size > HELD_COUNTS:
                held = {p: [_merged(parts)] for p, parts in held.items()}
                size = sum(len(part[0]) + PART_COUNTS for (part,) in held.values())
                if size > HELD_COUNTS // 2:
                    yield from handed_on(held)
                    held, size = {}, 0
        yield from handed_on({p: [_merged(parts)] for p, parts in held.items()})

    def handed_on(held: Mapping[int, list]) -> Iterator[pa.RecordBatch]:
        for place, ((prefix, n, least),) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(prefix), place, np.int32)), pa.array(prefix), pa.array(n), pa.array(least)],
                ["place", "prefix", "n", "least"],
            )

    counts = values.mapInArrow(fold, "place int, prefix bigint, n bigint, least double")
    return counts.groupBy("place", "prefix").agg(F.sum("n").alias("n"), F.min("least").alias("least"))


def _merged(parts: Sequence[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    prefix, n, least = (np.concatenate(arrays) for arrays in zip(*parts, strict=True))
    order = np.argsort(prefix, kind="stable")
    return _added(prefix[order], n[order], least[order])


def _added(prefix: np.ndarray, n: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per prefix of sorted ones."""
    starts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
    return prefix[starts], np.add.reduceat(n, starts), np.minimum.reduceat(least, starts)


def approximate_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, median)`` to 32 leading bits, by ``radix_medians``: two passes, the same in every run."""
    return radix_medians(df, columns).select("column", "median")


def exact_medians(df: DataFrame, columns: Sequence[str], stage_rows: bool = True) -> DataFrame:
    """``(column, median)``: the lower median, that is the value of rank ceil(n / 2).

    Summaries first bracket the middle of each column. One more pass counts what is below, inside and above; only values
    inside are shuffled by themselves, one row per distinct value and task, and ranked in order. A column whose middle
    is not inside is bracketed again more widely, so the answer is exact whatever the summaries say. ``stage_rows``
    writes the columns once, as both passes read them; turn it off for a scan of a columnar table.
    """
    spark = df.sparkSession
    if stage_rows:
        df = stage(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "median-rows")
    # Brackets of every width are taken from the summaries at once.
    ranks = [rank for width in BRACKETS for rank in (0.5 - width, 0.5 + width)]
    summaries = _quantiles(_sketches(df, columns, SKETCH_SIZE), ranks)
    found, open_places = _empty_medians(spark), list(summaries)
    for nth in range(len(BRACKETS) + 1):
        if not open_places:
            break
        widest = [float("-inf"), float("inf")]
        wanted = {p: [*summaries[p], *widest][2 * nth : 2 * nth + 2] for p in open_places}
        counts, at = _bracketed(df, columns, wanted)
        inside = {p: rank for p, (rank, held) in at.items() if 1 <= rank <= held}
        if inside:
            found = found.unionByName(_at_ranks(counts, inside))
        open_places = [p for p in wanted if p not in inside]
    return _places(spark, columns).join(found, on="place", how="left").select("column", "median")


def _bracketed(df: DataFrame, columns: Sequence[str], brackets: Mapping[int, Sequence[float]]) -> tuple[
    DataFrame, dict[int, tuple[int, int]]
]:
    """Counts of the values inside the brackets, and per column the middle's rank inside and how many rows are inside."""
    bounds = df.sparkSession.createDataFrame(
        [(p, *map(float, q)) for p, q in brackets.items()], "place int, lowest double, highest double"
    )
    side = F.when(F.col("value") < F.col("lowest"), -1).when(F.col("value") > F.col("highest"), 1).otherwise(0)
    counts = stage(
        long_values(df, columns).join(F.broadcast(bounds), on="place")  # one row per column
        .withColumn("side", side)
        .groupBy("place", "side", F.when(F.col("side") == 0, F.col("value")).alias("value"))
        .agg(F.count(F.lit(1)).alias("n")),
        "median-counts",
    )
    at = counts.groupBy("place").agg(
        (F.ceil(F.sum("n") / 2) - F.coalesce(F.sum(F.when(F.col("side") == -1, F.col("n"))), F.lit(0))).alias("rank"),
        F.coalesce(F.sum(F.when(F.col("side") == 0, F.col("n"))), F.lit(0)).alias("held"),
    )
    return counts.where(F.col("side") == 0), {r["place"]: (r["rank"], r["held"]) for r in at.collect()}


def _at_ranks(counts: DataFrame, ranks: Mapping[int, int]) -> DataFrame:
    """``(place, median)``: the value that holds the rank."""
    wanted = counts.sparkSession.createDataFrame(list(ranks.items()), "place int, rank bigint")
    # One row per column.
    chosen = counts.join(F.broadcast(wanted), on="place")
    ranked = running_totals(chosen, order=["value"], totals={"upto": F.col("n")}, groups=["place"])
    holds = (F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))
    return ranked.where(holds).select("place", F.col("value").alias("median"))


def _empty_medians(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "place int, median double")


def as_dict(state: DataFrame, value: str) -> dict[str, float]:
    """A per-column statistic on the driver: one value per declared column."""
    return {r["column"]: r[value] for r in state.select("column", value).collect()}


def impute_columns(df: DataFrame, medians: Mapping[str, float], outputs: Mapping[str, str]) -> DataFrame:
    """Null and NaN replaced by the fitted median, as doubles."""
    return df.withColumns({outputs[c]: impute(c, m) for c, m in medians.items()})


def scale_columns(df: DataFrame, ranges: DataFrame, outputs: Mapping[str, str]) -> DataFrame:
    """Columns min-max scaled to the fitted ranges; values outside are not clipped."""
    fitted = {r["column"]: (r["low"], r["high"]) for r in ranges.collect()}
    return df.withColumns({new: min_max(old, *fitted[old]) for old, new in outputs.items()})


def imputer(spark: SparkSession, medians: Mapping[str, float], outputs: Sequence[str]) -> ImputerModel:
    """Spark ML's imputer for known medians: it is fitted on the one row that holds them."""
    columns = list(medians)
    one_row = spark.createDataFrame([[float(m) for m in medians.values()]], schema=columns)
    return Imputer(inputCols=columns, outputCols=list(outputs), strategy="median").fit(one_row)


def scaler(
    spark: SparkSession, ranges: Sequence[tuple[float, float]], vector: str, output: str
) -> MinMaxScalerModel:
    """Spark ML's min-max scaler for known ranges: it is fitted on the two rows of lows and highs."""
    lows, highs = zip(*ranges, strict=True)
    two_rows = spark.createDataFrame([(Vectors.dense(lows),), (Vectors.dense(highs),)], schema=[vector])
    return MinMaxScaler(inputCol=vector, outputCol=output).fit(two_rows)


def assemble(df: DataFrame, columns: Sequence[str], output: str, invalid: str = "error") -> DataFrame:
    """One vector per row. Rows with null or NaN fail, are dropped ("skip") or hold NaN ("keep").

    Dropping looks for NaN in the finished vector: a null check per column makes the
    optimizer derive constraints for every combination of them, which blocks wide tables.
    """
    handle = "keep" if invalid == "skip" else invalid
    vectors = VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=handle).transform(df)
    if invalid != "skip":
        return vectors
    return vectors.where(~F.exists(vector_to_array(output), F.isnan))


def covariance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(row, col, covariance)``: sample covariance of all column pairs, both triangles.

    Rows with a null or NaN in any of the columns are left out. Each task folds its
    rows into one small matrix of products and hands it on as one row; these are added up in two levels.
    Values are taken relative to the column means, for precision.
    """
    width = len(columns)
    averages = long_values(df, columns).groupBy("place").agg(F.avg("value").alias("mean")).collect()
    if len(averages) < width:
        empty = sorted(set(columns) - {columns[r["place"]] for r in averages})
        raise ValueError(f"columns without any value: {', '.join(empty)}")
    means = np.array([r["mean"] for r in sorted(averages, key=lambda r: r["place"])])

    i, j = np.triu_indices(width)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, sums, products = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            centred = batch.to_numpy(dtype=float) - means
            complete = centred[~np.isnan(centred).any(axis=1)]
            rows += len(complete)
            sums += complete.sum(axis=0)
            products += complete.T @ complete
        if rows:
            yield pd.DataFrame(
                {
                    "part": [TaskContext.get().partitionId() % MERGE_GROUPS],
                    "packed": [np.r_[rows, sums, products[i, j]]],
                }
            )

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for packed in batch["packed"]:
                total = np.array(packed) if total is None else total + packed
        if total is not None:
            yield pd.DataFrame({"part": [0], "packed": [total]})

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for packed in batch["packed"]:
                rows, sums, products = packed[0], packed[1 : width + 1], packed[width + 1 :]
                above = i < j
                value = (products - sums[i] * sums[j] / rows) / (rows - 1) if rows > 1 else np.full(len(i), np.nan)
                yield pd.DataFrame(
                    {"i": np.r_[i, j[above]], "j": np.r_[j, i[above]], "covariance": np.r_[value, value[above]]}
                )

    names = F.array(*[F.lit(c) for c in columns])
    packed = "part int, packed array<double>"
    parts = df.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(columns)]).mapInPandas(
        fold, packed
    )
    # Tasks' arrays are added up in groups, one array at a time, then those of the groups: two levels for any number.
    grouped = parts.repartition("part").mapInPandas(add, packed)
    whole = grouped.repartition(1).mapInPandas(add, packed).mapInPandas(spread, "i int, j int, covariance double")
    value = F.when(~F.isnan("covariance"), F.col("covariance"))
    return whole.select(
        F.get(names, F.col("i")).alias("row"), F.get(names, F.col("j")).alias("col"), value.alias("covariance")
    )


def _places(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(columns)), "place int, column string")
