"""Running totals and neighbours over a whole ordered table.

A window without partitions puts the table into one task. Here the table is
range-partitioned into slices; each slice is worked on by itself and corrected
by what comes before it, which is known from one small row per slice.

Order columns must be unique per row (aggregate first), so that a value held by
many rows cannot fill a slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.staging import stage

SLICE = "_slice"


def slices_in_order(rows: DataFrame, order: Sequence[Column | str], slices: int | None = None) -> DataFrame:
    """Rows with the number of the slice they fall into; slices follow the order.

    The result is written, as slice numbers must not change between the passes.
    """
    count = slices or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(rows.repartitionByRange(count, *order).withColumn(SLICE, F.spark_partition_id()), "slices")


def running_totals(
    rows: DataFrame,
    order: Sequence[Column | str],
    totals: Mapping[str, Column],
    groups: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Adds, for each ``name: value`` of ``totals``, the sum of the values up to and
    including the row as ``name``, and the sum over its whole group as ``all_name``.

    With ``groups``, sums start anew in each group; rows are ordered by group first, and a null group is a group.
    The values must be non-null.
    """
    sliced = slices_in_order(rows, [*groups, *order], slices)
    # At most one row per slice, plus one per group: small enough to broadcast.
    per_slice = sliced.groupBy(SLICE, *groups).agg(*[F.sum(v).alias(f"in_{n}") for n, v in totals.items()])
    group = Window.partitionBy(*groups)
    before = group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    corrections = per_slice.select(
        SLICE,
        *groups,
        *[F.coalesce(F.sum(f"in_{n}").over(before), F.lit(0)).alias(f"before_{n}") for n in totals],
        *[F.sum(f"in_{n}").over(group).alias(f"all_{n}") for n in totals],
    )
    within = Window.partitionBy(SLICE, *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = sliced.select("*", *[F.sum(v).over(within).alias(f"within_{n}") for n, v in totals.items()])
    renamed = corrections.withColumnsRenamed({c: f"_of_{c}" for c in (SLICE, *groups)})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (SLICE, *groups)]
    return summed.join(F.broadcast(renamed), on=same).select(
        *rows.columns,
        *[(F.col(f"before_{n}") + F.col(f"within_{n}")).alias(n) for n in totals],
        *[f"all_{n}" for n in totals],
    )


def with_previous(rows: DataFrame, columns: Sequence[str], slices: int | None = None) -> DataFrame:
    """Rows ordered by ``columns``, each with those of the row before it as ``previous_*``.

    They are null in the first row.
    """
    sliced = slices_in_order(rows, columns, slices)
    row = F.struct(*columns)
    # One row per slice.
    last_rows = sliced.groupBy(SLICE).agg(F.max(row).alias("_last"))
    slice_before = last_rows.select(SLICE, F.lag("_last").over(Window.orderBy(SLICE)).alias("_before"))
    within = Window.partitionBy(SLICE).orderBy(*columns)
    return (
        sliced.withColumn("_lag", F.lag(row).over(within))
        .join(F.broadcast(slice_before), on=SLICE)
        .withColumn("_previous", F.coalesce("_lag", "_before"))
        .select(*rows.columns, *[F.col(f"_previous.{c}").alias(f"previous_{c}") for c in columns])
    )
