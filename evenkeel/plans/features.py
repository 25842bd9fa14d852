"""From wide rows to one feature vector: fit once, apply to any rows.

All statistics are taken from the data in a few shared passes (category counts,
ranges, medians, components); Spark ML's transformers are then set up from them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import PCA, SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from evenkeel.operators.categories import (
    BROADCAST_LABELS,
    LabelSize,
    apply_index,
    apply_indexes,
    category_counts,
    encoder,
    index_map,
    indexers,
    label_sizes,
)
from evenkeel.operators.numeric import (
    approximate_medians,
    as_dict,
    column_ranges,
    exact_medians,
    imputer,
    scaler,
)
from evenkeel.operators.rows import conform, fill_sentinel
from evenkeel.sources.artifacts import load_feature_model
from evenkeel.sources.published import current, publish
from evenkeel.spec import Block, FeatureSpec
from evenkeel.staging import stage, staged

ON_INVALID = ("error", "skip", "keep")
FILLS = ("impute", "sentinel")
SETTINGS = "spec string, joined array<struct<column: string, labels: bigint, text_bytes: bigint>>, before_join int"


@dataclass
class FittedFeatures:
    """Everything learned from the training rows.

    ``labels`` is ``(column, label, n, index)``, ``numeric`` is ``(column, low, high, median)``;
    ``joined`` holds the categories indexed by a join because they have too many
    labels for the driver, with the size of their labels. The join comes after the first ``before_join`` stages of the
    model, when blocks are vectors already.
    """

    spec: FeatureSpec
    model: PipelineModel
    labels: DataFrame
    numeric: DataFrame
    joined: dict[str, LabelSize] = field(default_factory=dict)
    before_join: int = 0

    def transform(self, df: DataFrame, fill: str = "impute") -> DataFrame:
        """Rows with all intermediate columns and ``features``.

        ``fill="impute"`` treats gaps as in training. ``fill="sentinel"`` first sets missing numbers to
        -999 and missing text to ``na``, so that no median is used and scaled values leave [0, 1].
        """
        if fill not in FILLS:
            raise ValueError(f"fill is one of {', '.join(FILLS)}, not {fill!r}")
        rows = conform(df, self.spec)
        if fill == "sentinel":
            rows = fill_sentinel(rows)
        if not self.joined:
            return self.model.transform(rows)
        rows = PipelineModel(self.model.stages[: self.before_join]).transform(rows)
        if len(self.joined) > 1:
            rows = apply_indexes(rows, self.labels, {c: f"{c}_idx" for c in self.joined}, self.joined)
        else:
            for c, size in self.joined.items():
                rows = apply_index(rows, self.labels, c, f"{c}_idx", size=size, spread_by=[self.spec.key])
        return PipelineModel(self.model.stages[self.before_join :]).transform(rows)

    def feature_table(self, df: DataFrame, fill: str = "impute") -> DataFrame:
        """``(key, features)``, with the label if the rows have one."""
        rows = self.transform(df, fill)
        label = [self.spec.label] if self.spec.label in rows.columns else []
        return rows.select(self.spec.key, "features", *label)

    def save(self, path: str) -> None:
        """Publishes model, labels, numbers and settings together: a state saved there before stays whole until then."""
        publish(self.labels.sparkSession, path, self._write, tables=("labels", "numeric"))

    def _write(self, folder: str) -> None:
        self.model.write().save(f"{folder}/model")
        self.labels.write.parquet(f"{folder}/labels")
        self.numeric.write.parquet(f"{folder}/numeric")
        joined = [(c, size.labels, size.text_bytes) for c, size in self.joined.items()]
        settings = [(self.spec.to_json(), joined, self.before_join)]
        self.labels.sparkSession.createDataFrame(settings, SETTINGS).coalesce(1).write.json(f"{folder}/settings")

    @staticmethod
    def load_spec(spark: SparkSession, path: str) -> FeatureSpec:
        return FeatureSpec.from_json(_settings(spark, current(spark, path))["spec"])

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedFeatures:
        folder = current(spark, path)
        settings = _settings(spark, folder)
        return cls(
            spec=FeatureSpec.from_json(settings["spec"]),
            model=load_feature_model(f"{folder}/model"),
            labels=spark.read.parquet(f"{folder}/labels"),
            numeric=spark.read.parquet(f"{folder}/numeric"),
            joined={r["column"]: LabelSize(r["labels"], r["text_bytes"]) for r in settings["joined"]},
            before_join=settings["before_join"],
        )


def fit_features(
    df: DataFrame,
    spec: FeatureSpec,
    compat: bool = False,
    on_invalid: str = "error",
    median: str = "exact",
    drop_empty: bool = False,
    labels_on_driver: int = BROADCAST_LABELS,
    stage_rows: bool = True,
) -> FittedFeatures:
    """Learn the feature stages from training rows.

    compat: encode categories as index, imputed index, one-hot without metadata. Values unseen in
        training then share the slot of null, or have none if training had no null. By
        default each column has one slot more than labels, for null and unseen values.
    on_invalid: what to do with rows whose amount has no logarithm: fail with their
        number, skip them (they then count for no statistic), or keep them as NaN.
    median: "exact" (the lower median) or "approximate" (to 32 leading bits, in two passes).
    drop_empty: leave out block columns without any value instead of failing.
    labels_on_driver: all categories' labels together that may go to the driver; beyond, or with too much text in
        them, the columns with the most labels are indexed by a join.
    stage_rows: write the projected rows once, for the time of the fit, and let all passes read
        that; turn off if ``df`` is a plain scan of a columnar table already.
    """
    if on_invalid not in ON_INVALID:
        raise ValueError(f"on_invalid is one of {', '.join(ON_INVALID)}, not {on_invalid!r}")
    if median not in ("approximate", "exact"):
        raise ValueError(f"median is approximate or exact, not {median!r}")
    rows = conform(df, spec)
    if on_invalid == "skip":
        for c in spec.amounts:
            rows = rows.where(_has_logarithm(c))
    options = (compat, on_invalid, median, drop_empty, labels_on_driver)
    if not stage_rows:
        return _fit_rows(rows, spec, *options)
    with staged(rows, "rows") as written:
        return _fit_rows(written, spec, *options)


def _fit_rows(
    rows: DataFrame,
    spec: FeatureSpec,
    compat: bool,
    on_invalid: str,
    median: str,
    drop_empty: bool,
    labels_on_driver: int,
) -> FittedFeatures:
    spark = rows.sparkSession
    if on_invalid == "error":
        _require_logarithms(rows, spec)

    ranges = {}
    medians = {}
    if spec.block_columns:
        low_high = {r["column"]: (r["low"], r["high"]) for r in column_ranges(rows, spec.block_columns).collect()}
        empty = {c for c, (low, _) in low_high.items() if low is None}
        if empty and not drop_empty:
            raise ValueError(f"block columns without any value: {', '.join(sorted(empty))}")
        spec = spec.without(empty)
        ranges = {c: low_high[c] for c in spec.block_columns}
        # The rows are a written table already.
        middle = exact_medians(
            rows, spec.block_columns, stage_rows=False
        ) if median == "exact" else approximate_medians(rows, spec.block_columns)
        found = as_dict(middle, "median")
        medians = {c: found[c] for c in spec.block_columns}

    stages: list[Transformer] = []
    parts: list[str] = []
    if spec.amounts:
        logs = ", ".join(f"ln(`{c}` + 1) AS `{out}`" for c, out in zip(spec.amounts, spec.logged(), strict=True))
        stages.append(SQLTransformer(statement=f"SELECT *, {logs} FROM __THIS__"))
        stages.append(VectorAssembler(inputCols=spec.logged(), outputCol="num_cols", handleInvalid=on_invalid))
        parts.append("num_cols")

    labels, joined = _empty_labels(spark), {}
    category_stages: list[Transformer] = []
    if spec.categories:
        labels = stage(index_map(category_counts(rows, spec.categories)), "labels")
        category_stages, joined = _category_stages(rows, labels, spec, compat, labels_on_driver)

    block_stages: list[Transformer] = []
    if spec.block_columns:
        block_stages = _block_stages(rows, spec.blocks, ranges, medians)
    parts += [block.output for block in spec.blocks] + spec.encoded()
    # Blocks first: an indexer is a projection of its own to Spark, and should carry a few vectors through
    # rather than hundreds of columns.
    before_join = len(stages) + len(block_stages)
    stages += block_stages + category_stages
    stages.append(
        VectorAssembler(
            inputCols=parts, outputCol="features", handleInvalid="keep" if on_invalid == "keep" else "error"
        )
    )
    numeric = spark.createDataFrame(
        [(c, float(ranges[c][0]), float(ranges[c][1]), float(medians[c])) for c in spec.block_columns],
        "column string, low double, high double, median double",
    )
    return FittedFeatures(spec, PipelineModel(stages), labels, numeric, joined, before_join)


def _has_logarithm(amount: str) -> Column:
    return F.coalesce((F.col(amount) > -1) & ~F.isnan(amount), F.lit(False))


def _require_logarithms(rows: DataFrame, spec: FeatureSpec) -> None:
    if not spec.amounts:
        return
    bad = rows.agg(*[F.count_if(~_has_logarithm(c)).alias(c) for c in spec.amounts]).first()
    found = [f"{c} ({bad[c]} rows)" for c in spec.amounts if bad[c]]
    if found:
        raise ValueError(f"amounts that are missing or not above -1: {', '.join(found)}")


def _category_stages(
    rows: DataFrame, labels: DataFrame, spec: FeatureSpec, compat: bool, labels_on_driver: int
) -> tuple[list[Transformer], dict[str, LabelSize]]:
    spark = rows.sparkSession
    sizes_of = {c: LabelSize() for c in spec.categories} | label_sizes(labels)
    known = {c: sizes_of[c].labels for c in spec.categories}
    joined = _too_many(sizes_of, labels_on_driver)
    local = [c for c in spec.categories if c not in joined]
    stages: list[Transformer] = []
    if local:
        stages += indexers(labels, local)
    if not compat:
        sizes = [known[c] + 1 for c in spec.categories]
        return [*stages, encoder(spark, sizes, spec.indexed(), spec.encoded())], joined
    # Index columns hold no null, so this changes no value; it only hides the labels from the encoder.
    stages.append(imputer(spark, {c: 0.0 for c in spec.indexed()}, spec.imputed_index()))
    nulls = rows.agg(*[F.max(F.col(c).isNull()).alias(c) for c in spec.categories]).first()
    sizes = [max(1, known[c] + bool(nulls[c])) for c in spec.categories]
    return [*stages, encoder(spark, sizes, spec.imputed_index(), spec.encoded())], joined


def _too_many(sizes: dict[str, LabelSize], labels_on_driver: int) -> dict[str, LabelSize]:
    """The columns whose labels stay off the driver: the largest, until the rest is within bounds together."""
    smallest_first = sorted(sizes, key=lambda c: (sizes[c].text_bytes, sizes[c].labels, c))
    whole, joined = LabelSize(), {}
    for c in smallest_first:
        with_it = LabelSize(whole.labels + sizes[c].labels, whole.text_bytes + sizes[c].text_bytes)
        if with_it.within(labels_on_driver):
            whole = with_it
        else:
            joined[c] = sizes[c]
    return {c: joined[c] for c in sizes if c in joined}


def _block_stages(
    rows: DataFrame,
    blocks: tuple[Block, ...],
    ranges: dict[str, tuple[float, float]],
    medians: dict[str, float],
) -> list[Transformer]:
    spark = rows.sparkSession
    fill = imputer(spark, medians, [f"{c}_nan" for c in medians])
    stages: list[Transformer] = [fill]
    for block in blocks:
        # Imputed columns have no gaps left that a row would have to be skipped for.
        assemble = VectorAssembler(inputCols=[f"{c}_nan" for c in block.columns], outputCol=block.assembled)
        scale = scaler(spark, [ranges[c] for c in block.columns], block.assembled, block.scaled)
        stages += [assemble, scale]
        if block.components:
            vectors = scale.transform(assemble.transform(fill.transform(rows.select(*medians))))
            pca = PCA(k=block.components, inputCol=block.scaled, outputCol=block.output)
            stages.append(pca.fit(vectors.select(block.scaled)))
    return stages


def _settings(spark: SparkSession, path: str) -> Row:
    return spark.read.schema(SETTINGS).json(f"{path}/settings").first()


def _empty_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "column string, label string, n bigint, index bigint")
