"""Category columns: frequencies, indices and one-hot slots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.operators.hot import brief, look_up
from evenkeel.operators.ordered import running_totals
from evenkeel.operators.rows import hashable_columns
from evenkeel.staging import stage

# Label tables up to this many rows and bytes of text are sent to every task, or to the driver;
# larger ones are joined by shuffle.
BROADCAST_LABELS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024

# A value held by one part in this many of the rows is hot; there are at most as many such values.
HOT_PARTS = 1000


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, label, n)`` for all columns in one scan; nulls count as a null label.

    Rows are counted before the shuffle, so a label that most rows share costs
    one row per task.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in columns]
    return (
        df.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.column", "pair.label")
        .groupBy("column", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def index_map(counts: DataFrame) -> DataFrame:
    """``(column, label, n, index)``: labels numbered from 0 per column, most frequent
    first, ties in label order. No task holds a whole column's labels."""
    numbered = running_totals(
        counts.where(F.col("label").isNotNull()),
        order=[F.desc("n"), F.col("label")],
        totals={"position": F.lit(1)},
        groups=["column"],
    )
    return numbered.select("column", "label", "n", (F.col("position") - 1).alias("index"))


@dataclass(frozen=True)
class LabelSize:
    labels: int = 0
    text_bytes: int = 0

    def within(self, labels: int, text_bytes: int = BROADCAST_BYTES) -> bool:
        return self.labels <= labels and self.text_bytes <= text_bytes


def label_sizes(labels: DataFrame) -> dict[str, LabelSize]:
    """Number and size of the labels per column; columns without labels are not in it."""
    sizes = labels.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("label")).alias("text_bytes")
    )
    return {r["column"]: LabelSize(r["n"], r["text_bytes"]) for r in sizes.collect()}


def apply_index(
    df: DataFrame,
    labels: DataFrame,
    column: str,
    output: str,
    map_column: str | None = None,
    broadcast_up_to: int = BROADCAST_LABELS,
    size: LabelSize | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Adds the index of each value as double; null and unknown values get one index
    past the last label.

    ``map_column`` names the entry of ``labels`` to use if it differs from ``column``.
    A label table of more than ``broadcast_up_to`` rows, or too much text, is joined by
    shuffle, except for the values that are hot in ``df``, known or not. ``size`` is the entry's size if it is known;
    no job runs then. Rows that need no shuffle are spread by a hash of ``spread_by``, by default of the whole row.
    """
    of_column = labels.where(F.col("column") == (map_column or column))
    entry = of_column.select(F.col("label").alias("_label"), F.col("index").cast("double").alias("_index"))
    if size is None:
        size = label_sizes(of_column).get(map_column or column, LabelSize())
    keyed = df.withColumn("_label", F.col(column).cast("string"))
    if size.within(broadcast_up_to):
        found = keyed.join(F.broadcast(entry), on="_label", how="left")
    else:
        found = _join_hot_then_rest(keyed, entry, spread_by or hashable_columns(keyed))
    return found.select(*df.columns, F.coalesce("_index", F.lit(float(size.labels))).alias(output))


def _join_hot_then_rest(keyed: DataFrame, entry: DataFrame, spread_by: Sequence[str]) -> DataFrame:
    """Hot values are counted in the rows and looked up once each; at most ``HOT_PARTS`` digests are sent to every task,
    whatever the length of the labels. Rows that are done, or have no label, go through the second join under keys of
    their own, so that they do not meet in one partition."""
    digest = F.unhex(F.md5("_label"))
    keyed, entry = keyed.withColumn("_digest", digest), entry.select(digest.alias("_digest"), "_index")
    counts = keyed.where(F.col("_label").isNotNull()).groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") * HOT_PARTS >= counts.agg(F.sum("_n")).scalar()).select("_digest")
    found = hot.join(entry, on="_digest", how="left").select(
        "_digest", F.col("_index").alias("_hot"), F.lit(True).alias("_done")
    )
    looked_up = keyed.join(F.broadcast(found), on="_digest", how="left")
    is_open = F.col("_done").isNull() & F.col("_label").isNotNull()
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(10_000)).cast("int") + 1
    # Always 0, but not a constant the optimizer would take out of the join key.
    rest = entry.withColumn("_spread", F.pmod(F.hash("_digest"), F.lit(1)).cast("int"))
    return (
        looked_up.withColumns({
            "_digest": F.when(is_open, F.col("_digest")),
            "_spread": F.when(is_open, F.lit(0)).otherwise(spread),
        })
        .join(rest, on=["_digest", "_spread"], how="left")
        .withColumn("_index", F.coalesce("_hot", "_index"))
    )


def apply_indexes(
    df: DataFrame, labels: DataFrame, outputs: Mapping[str, str], sizes: Mapping[str, LabelSize] | None = None
) -> DataFrame:
    """As ``apply_index`` for several columns with many labels at once: ``outputs`` names the column of each index.

    The rows are written once with a number. Their values go below each other in brief form, are counted, and the distinct
    ones are joined once with the labels of all columns; the indices found come back to their row by its number. So the
    whole rows are shuffled once, by number, however many columns there are, and values that many rows share, known to the
    labels or not, are looked up once and broadcast. Values are read from the written rows in every pass, not written
    again; those without a label go no further than their lookup.
    """
    columns = list(outputs)
    if sizes is None:
        sizes = label_sizes(labels.where(F.col("column").isin(*columns)))
    number = F.monotonically_increasing_id().alias("row")
    rows = stage(df.select(number, F.struct("*").alias("item")), "indexed-rows")
    texts = [F.col("item")[c].cast("string") for c in columns]
    # Row and column are one number, which makes what is shuffled by value smaller.
    pairs = [
        F.struct(
            (F.col("row") * len(columns) + i).alias("cell"), brief(F.concat(F.lit(f"{i}:"), text)).alias("value")
        )
        for i, text in enumerate(texts)
    ]
    values = rows.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())
    (total,) = rows.agg(F.coalesce(F.sum(sum(t.isNotNull().cast("bigint") for t in texts)), F.lit(0))).first()
    counts = values.groupBy("value").agg(F.count(F.lit(1)).alias("copies"))
    places = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, f"{i}:")])
    known = labels.where(F.col("column").isin(*columns)).select(
        brief(F.concat(places[F.col("column")], "label")).alias("value"), F.col("index").cast("double").alias("index")
    )
    # Unknown values matter only where they are hot.
    dictionary = stage(
        counts.join(known, "value", "left").where(
            F.col("index").isNotNull() | (F.col("copies") * HOT_PARTS >= F.lit(total))
        ),
        "dictionary",
    )
    found = look_up(values, dictionary, "value", "copies", total, HOT_PARTS).where(F.col("index").isNotNull())
    # A row's values come from different tasks, so there is nothing to fold before the shuffle.
    of_rows = found.select(
        F.expr(f"cell div {len(columns)}").alias("row"), (F.col("cell") % len(columns)).alias("place"), "index"
    ).repartition("row")
    folded = of_rows.groupBy("row").agg(
        *[F.max(F.when(F.col("place") == i, F.col("index"))).alias(f"index_{i}") for i in range(len(columns))]
    )
    indices = [
        F.coalesce(f"index_{i}", F.lit(float(sizes.get(c, LabelSize()).labels))).alias(outputs[c])
        for i, c in enumerate(columns)
    ]
    return rows.join(folded, "row", "left").select("item.*", *indices)


def indexers(labels: DataFrame, columns: Sequence[str]) -> list[StringIndexerModel]:
    """Spark ML's indexers from ``c`` to ``c_idx`` for already numbered labels.

    The labels cross the driver: call it for columns whose number of labels has
    been checked. One model per column, as a shared one would pad the columns to
    the longest list of labels.
    """
    by_column: dict[str, list[str]] = {c: [] for c in columns}
    for row in labels.where(F.col("column").isin(*columns)).orderBy("column", "index").collect():
        by_column[row["column"]].append(row["label"])
    return [StringIndexerModel.from_labels(by_column[c], c, f"{c}_idx", handleInvalid="keep") for c in columns]


def encoder(
    spark: SparkSession, sizes: Sequence[int], inputs: Sequence[str], outputs: Sequence[str]
) -> OneHotEncoderModel:
    """One-hot encoder whose blocks have the given sizes; indices beyond give an empty block.

    The encoder learns a size as largest index plus one; one row with these
    indices tells it, without a pass over the data.
    """
    largest = spark.createDataFrame([[float(s - 1) for s in sizes]], schema=[*inputs])
    return OneHotEncoder(inputCols=list(inputs), outputCols=list(outputs), handleInvalid="keep").fit(largest)
