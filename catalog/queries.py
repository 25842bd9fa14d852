"""One query per operator, over the whole test tables."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.scalars import logistic, min_max
from evenkeel.operators import balance, categories, metrics, numeric, permutation, roc, rows
from evenkeel.plans import classifier, jobs
from evenkeel.plans.features import FittedFeatures, fit_features
from evenkeel.sources import artifacts, evidence, published, tables
from evenkeel.spec import Block, FeatureSpec, family
from evenkeel.staging import scratch_path, stage

Query = Callable[[SparkSession, str], DataFrame]

DIMENSIONS = 64
E = family("E", 0, DIMENSIONS - 1)
CATALOG: dict[str, Query] = {}


def query(function: Query) -> Query:
    CATALOG[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.read_parquet(spark, f"{sf_dir}/{name}.parquet")


# ---- inputs shared by several queries


def labelled_documents(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return rows.enrich(documents, table(spark, d, "labels"), "doc_id")


def wide_documents(spark: SparkSession, d: str) -> DataFrame:
    embeddings = rows.spread_array(
        table(spark, d, "embeddings"), "embedding", E, F.col("vec_id").alias("doc_id")
    )
    return rows.enrich(labelled_documents(spark, d), embeddings, "doc_id")


def document_spec(components: int | None = 12) -> FeatureSpec:
    return FeatureSpec(
        key="doc_id",
        label="toxic",
        amounts=("n_chars",),
        categories=("lang", "source"),
        blocks=(Block("e", E, components),),
    )


def scored_events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id",
        (F.col("event_type") == "error").cast("int").alias("label"),
        F.col("value").alias("score"),
        (F.col("value") > 50).cast("double").alias("prediction"),
    )


def lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("line_id"),
        F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("kind"),
        (F.col("l_linestatus") == "O").cast("int").alias("open"),
    )


def line_features(spark: SparkSession, d: str) -> DataFrame:
    spec = FeatureSpec(key="line_id", label="open", categories=("kind",), key_type="string")
    data = lines(spark, d)
    return stage(fit_features(data, spec).transform(data).select("line_id", "kind", "open", "features"), "features")


# With one slot per category and no penalty, the fitted probability of a category is its
# share of positives, which SQL can tell.
TO_CONVERGENCE = {"max_iter": 200, "tolerance": 1e-12}


# ---- sources and sinks


@query
def scan_csv_typed(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    orders = table(spark, d, "orders")
    tables.write_csv(orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")), path)
    types = {"o_orderkey": T.LongType(), "o_custkey": T.LongType(), "o_totalprice": T.DoubleType()}
    return tables.read_csv(spark, path, types)


@query
def csv_text_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts, with their quotes, blanks and line breaks, through CSV and back."""
    path = scratch_path(spark, "texts")
    documents = table(spark, d, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), "text"
    )
    conversations = table(spark, d, "conversations").select(
        F.lit("turn").alias("kind"), F.col("conv_id").alias("id"), "turn", "text"
    )
    tables.write_csv(documents.unionByName(conversations), path)
    return tables.read_csv(spark, path, {"id": T.LongType(), "turn": T.LongType()}, multi_line=True)


@query
def csv_type_evidence(spark: SparkSession, d: str) -> DataFrame:
    """What the cells of orders' CSV columns say about their types; ``note`` mixes numbers and words."""
    path = scratch_path(spark, "untyped")
    orders = table(spark, d, "orders")
    is_partial = F.col("o_orderstatus") == "P"
    tables.write_csv(
        orders.select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
            (F.col("o_totalprice") > 1000).alias("dear"),
            F.when(is_partial, F.concat(F.lit("part "), "o_orderpriority"))
            .otherwise(F.col("o_custkey").cast("string"))
            .alias("note"),
            F.when(~is_partial, F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("code"),
            F.when(is_partial, F.col("o_orderkey") * 10_000_000_000).alias("wide"),
        ),
        path,
    )
    found = evidence.csv_evidence(spark, path)
    kept = ["column", "type", "values", "nulls", "padded", "mostly", "misfits", "example"]
    return found.select(*kept)


@query
def csv_proposed_read(spark: SparkSession, d: str) -> DataFrame:
    """Orders through CSV and back, with the types that the evidence proposes."""
    path = scratch_path(spark, "proposed")
    tables.write_csv(
        table(spark, d, "orders").select(
            "o_orderkey", "o_totalprice", "o_orderstatus", (F.col("o_totalprice") > 1000).alias("dear")
        ),
        path,
    )
    back = tables.read_csv(spark, path, evidence.proposed_types(evidence.csv_evidence(spark, path)))
    return back.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query
def scan_parquet_project(spark: SparkSession, d: str) -> DataFrame:
    chosen = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rows.rename(chosen, ["order_key", "customer", "price"])


@query
def sink_parquet_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "overwritten")
    tables.write_parquet(table(spark, d, "supplier"), path)
    tables.write_parquet(table(spark, d, "customer"), path)
    return tables.read_parquet(spark, path).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query
def sink_published_state(spark: SparkSession, d: str) -> DataFrame:
    """One state replaces another; a writer that fails half-way in between changes nothing."""
    path = scratch_path(spark, "published")
    published.publish_parquet(table(spark, d, "supplier"), path)
    state = published.publish_parquet(table(spark, d, "customer"), path)

    def failing(folder: str) -> None:
        table(spark, d, "nation").write.parquet(folder)
        raise OSError("half-way")

    with contextlib.suppress(OSError):
        published.publish(spark, path, failing)
    rows_told = F.lit(state.rows[""]).cast("bigint").alias("rows_told")
    return published.read_published(spark, path).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", rows_told)


# ---- projections, fills, joins


@query
def left_join_enrich(spark: SparkSession, d: str) -> DataFrame:
    joined = labelled_documents(spark, d)
    return joined.withColumns({c: F.col(c).cast("bigint") for c in ("quality", "toxic")})


@query
def left_join_salted(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    return rows.enrich(customers, orders, "custkey", salts=4)


@query
def left_join_hot_keys(spark: SparkSession, d: str) -> DataFrame:
    """Facts of which a third have one key; only its details are copied."""
    one = F.when(F.col("l_linenumber") <= 2, F.lit(1).cast("bigint")).otherwise(F.col("l_suppkey"))
    facts = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", one.alias("suppkey"))
    details = table(spark, d, "supplier").select(F.col("s_suppkey").alias("suppkey"), "s_name", "s_acctbal")
    joined = rows.enrich_spread(stage(facts, "facts"), details, "suppkey")
    return joined.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))


@query
def left_join_null_keys(spark: SparkSession, d: str) -> DataFrame:
    """Facts of which most have no key."""
    labels = table(spark, d, "labels").select(
        F.col("doc_id").alias("labelled"), F.col("quality").cast("bigint").alias("quality")
    )
    documents = table(spark, d, "documents").select(
        "doc_id", F.when(F.col("lang") != "en", F.col("doc_id")).alias("labelled")
    )
    return rows.enrich(documents, labels, "labelled", salts=4)


@query
def fill_sentinel(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "n_chars")
    labels = table(spark, d, "labels").withColumn("grade", F.concat(F.lit("q"), "quality"))
    filled = rows.fill_sentinel(rows.enrich(documents, labels, "doc_id"))
    return filled.withColumns({c: F.col(c).cast("bigint") for c in ("quality", "toxic")})


@query
def log_amount(spark: SparkSession, d: str) -> DataFrame:
    logged = rows.log_columns(table(spark, d, "orders"), {"o_totalprice": "logged"})
    return logged.select("o_orderkey", F.round("logged", 9).alias("logged"))


@query
def log_nonpositive(spark: SparkSession, d: str) -> DataFrame:
    logged = rows.log_columns(table(spark, d, "customer"), {"c_acctbal": "logged"})
    return logged.select("c_custkey", F.round("logged", 9).alias("logged"))


@query
def family_project(spark: SparkSession, d: str) -> DataFrame:
    return rows.spread_array(table(spark, d, "embeddings"), "embedding", E, "vec_id")


@query
def preview_topn(spark: SparkSession, d: str) -> DataFrame:
    return rows.preview(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")


# ---- classes


@query
def label_split(spark: SparkSession, d: str) -> DataFrame:
    positives, negatives = balance.split_classes(labelled_documents(spark, d), "toxic")
    return (
        positives.select("doc_id", F.lit("positive").alias("part"))
        .unionByName(negatives.select(F.lit("negative").alias("part"), "doc_id"))
    )


@query
def class_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = balance.class_counts(labelled_documents(spark, d), "toxic")
    return counts.select(F.col("label").cast("bigint").alias("label"), "n")


@query
def class_balance_ratio(spark: SparkSession, d: str) -> DataFrame:
    return balance.class_balance(labelled_documents(spark, d), "toxic").withColumn("ratio", F.round("ratio", 9))


@query
def oversample_replicate(spark: SparkSession, d: str) -> DataFrame:
    balanced, _ = balance.balance_classes(labelled_documents(spark, d), "toxic", "doc_id")
    return balanced.select("doc_id", F.col("toxic").cast("bigint").alias("toxic"))


@query
def oversample_poisson(spark: SparkSession, d: str) -> DataFrame:
    labels = labelled_documents(spark, d).select("doc_id", "toxic")
    balanced, _ = balance.balance_classes(labels, "toxic", "doc_id", mode="poisson")
    return balanced.select("doc_id", F.col("toxic").cast("bigint").alias("toxic"))


@query
def balance_weight(spark: SparkSession, d: str) -> DataFrame:
    weighted, _ = balance.balance_classes(labelled_documents(spark, d), "toxic", "doc_id", mode="weight")
    return weighted.select("doc_id", F.round("weight", 9).alias("weight"))


@query
def shuffle_rows(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    shuffled = balance.shuffle_rows(labels, partitions=4)
    return shuffled.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("quality", "toxic")])


@query
def shuffle_positions(spark: SparkSession, d: str) -> DataFrame:
    """The place of every order, numbered by its key, in the seeded permutation."""
    orders = table(spark, d, "orders").select("o_orderkey")
    return orders.withColumn("place", permutation.place_of(F.col("o_orderkey"), orders.count(), balance.SEED))


@query
def shuffle_permuted(spark: SparkSession, d: str) -> DataFrame:
    permuted = permutation.permute_rows(table(spark, d, "labels"), balance.SEED, partitions=4)
    return permuted.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("quality", "toxic")])


@query
def holdout_split(spark: SparkSession, d: str) -> DataFrame:
    fit, held = balance.hold_out(table(spark, d, "documents").select("doc_id"), "doc_id", 0.2)
    return fit.withColumn("held_out", F.lit(False)).unionByName(held.withColumn("held_out", F.lit(True)))


# ---- categories


@query
def category_counts(spark: SparkSession, d: str) -> DataFrame:
    return categories.category_counts(labelled_documents(spark, d), ["lang", "source", "quality"])


@query
def category_index_map(spark: SparkSession, d: str) -> DataFrame:
    counts = categories.category_counts(table(spark, d, "documents"), ["lang", "source"])
    return categories.index_map(counts)


@query
def category_index_map_many(spark: SparkSession, d: str) -> DataFrame:
    counts = categories.category_counts(table(spark, d, "orders"), ["o_custkey", "o_orderpriority", "o_orderstatus"])
    return categories.index_map(counts)


def _document_index(spark: SparkSession, d: str, broadcast_up_to: int) -> DataFrame:
    known = categories.index_map(categories.category_counts(table(spark, d, "labels"), ["doc_id"]))
    documents = table(spark, d, "documents").select("doc_id", "lang")
    return categories.apply_index(documents, known, "doc_id", "doc_idx", broadcast_up_to=broadcast_up_to)


@query
def category_index_apply(spark: SparkSession, d: str) -> DataFrame:
    return _document_index(spark, d, categories.BROADCAST_LABELS)


@query
def category_index_apply_shuffled(spark: SparkSession, d: str) -> DataFrame:
    return _document_index(spark, d, 0)


@query
def category_index_apply_joined(spark: SparkSession, d: str) -> DataFrame:
    """Three large categories at once, with labels learned from part of the rows."""
    lineitem = table(spark, d, "lineitem")
    columns = ["l_orderkey", "l_partkey", "l_suppkey"]
    known = categories.index_map(categories.category_counts(lineitem.where("l_returnflag = 'R'"), columns))
    items = lineitem.select(*columns, F.col("l_linenumber").cast("bigint").alias("l_linenumber"))
    return categories.apply_indexes(items, stage(known, "known"), {c: f"{c}_idx" for c in columns})


@query
def category_index_apply_sentinel(spark: SparkSession, d: str) -> DataFrame:
    """Most rows hold the text that stands for a missing one, which the labels do not know."""
    known = categories.index_map(categories.category_counts(table(spark, d, "labels"), ["doc_id"]))
    joined = labelled_documents(spark, d).select(
        "doc_id", F.when(F.col("toxic") == 1, F.col("doc_id").cast("string")).alias("name")
    )
    filled = rows.fill_sentinel(joined)
    return categories.apply_index(
        filled, known, "name", "name_idx", map_column="doc_id", broadcast_up_to=0, spread_by=["doc_id"]
    )


@query
def category_index_model(spark: SparkSession, d: str) -> DataFrame:
    nations = categories.category_counts(
        table(spark, d, "supplier").withColumnRenamed("s_nationkey", "nation"), ["nation"]
    )
    (model,) = categories.indexers(categories.index_map(nations), ["nation"])
    customers = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    return model.transform(customers).select("c_custkey", "nation_idx")


@query
def onehot_long(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "lang", "source")
    columns = ["lang", "source"]
    known = categories.index_map(categories.category_counts(documents, columns))
    sizes = categories.label_sizes(known)
    encode = categories.encoder(
        spark, [sizes[c].labels + 1 for c in columns], ["lang_idx", "source_idx"], ["lang_enc", "source_enc"]
    )
    encoded = encode.transform(PipelineModel(categories.indexers(known, columns)).transform(documents))
    slots = [
        F.struct(
            F.lit(c).alias("column"),
            (F.array_position(vector_to_array(f"{c}_enc"), 1.0) - 1).alias("slot"),
            F.size(vector_to_array(f"{c}_enc")).cast("bigint").alias("width"),
        )
        for c in columns
    ]
    return encoded.select("doc_id", F.explode(F.array(*slots)).alias("s")).select("doc_id", "s.*")


# ---- numeric columns

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def median_fit(spark: SparkSession, d: str) -> DataFrame:
    return numeric.exact_medians(table(spark, d, "lineitem"), LINE_NUMBERS)


@query
def median_fit_approximate(spark: SparkSession, d: str) -> DataFrame:
    """To 32 leading bits: the value, and how many rows are smaller or share the bits."""
    return numeric.radix_medians(table(spark, d, "lineitem"), LINE_NUMBERS)


@query
def median_impute(spark: SparkSession, d: str) -> DataFrame:
    wide = wide_documents(spark, d).select("doc_id", *E)
    medians = numeric.as_dict(numeric.exact_medians(wide, E), "median")
    model = numeric.imputer(spark, {c: medians[c] for c in E}, [f"{c}_nan" for c in E])
    return model.transform(wide).select("doc_id", *[F.col(f"{c}_nan").alias(c) for c in E])


@query
def median_impute_expression(spark: SparkSession, d: str) -> DataFrame:
    joined = labelled_documents(spark, d)
    medians = numeric.as_dict(numeric.exact_medians(joined, ["quality", "toxic"]), "median")
    return numeric.impute_columns(joined, medians, {c: c for c in medians}).select("doc_id", "quality", "toxic")


@query
def minmax_fit(spark: SparkSession, d: str) -> DataFrame:
    return numeric.column_ranges(table(spark, d, "lineitem"), LINE_NUMBERS)


@query
def minmax_scale(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    ranges = numeric.column_ranges(orders, ["o_totalprice"])
    scaled = numeric.scale_columns(orders, ranges, {"o_totalprice": "scaled"})
    return scaled.select("o_orderkey", F.round("scaled", 9).alias("scaled"))


@query
def minmax_scale_vector(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select("c_custkey", "c_acctbal", F.lit(5.0).alias("constant"))
    suppliers = table(spark, d, "supplier").select(F.col("s_acctbal").alias("c_acctbal"), F.lit(5.0).alias("constant"))
    columns = ["c_acctbal", "constant"]
    found = {r["column"]: (r["low"], r["high"]) for r in numeric.column_ranges(suppliers, columns).collect()}
    model = numeric.scaler(spark, [found[c] for c in columns], "raw", "scaled")
    vectors = numeric.assemble(customers, columns, "raw")
    values = vector_to_array("scaled")
    return model.transform(vectors).select(
        "c_custkey", F.round(values[0], 9).alias("scaled"), F.round(values[1], 9).alias("constant")
    )


def _assembled(data: DataFrame, key: str, invalid: str) -> DataFrame:
    vectors = numeric.assemble(data, E, "block", invalid)
    values = vector_to_array("block")
    return vectors.select(
        key,
        F.size(values).cast("bigint").alias("width"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
        F.round(_weighted(values), 6).alias("weighted"),
    )


def _weighted(values):
    by_place = F.transform(values, lambda x, i: x * (i + 1))
    return F.aggregate(by_place, F.lit(0.0), lambda a, x: a + x)


@query
def assemble_block_error(spark: SparkSession, d: str) -> DataFrame:
    return _assembled(family_project(spark, d), "vec_id", "error")


@query
def assemble_block_skip(spark: SparkSession, d: str) -> DataFrame:
    return _assembled(wide_documents(spark, d).select("doc_id", *E), "doc_id", "skip")


@query
def covariance_matrix(spark: SparkSession, d: str) -> DataFrame:
    found = numeric.covariance(family_project(spark, d), E)
    return found.withColumn("covariance", F.round("covariance", 9))


def _components(spark: SparkSession, d: str, k: int) -> DataFrame:
    vectors = numeric.assemble(family_project(spark, d), E, "block")
    projected = PCA(k=k, inputCol="block", outputCol="parts").fit(vectors).transform(vectors)
    return projected.select("vec_id", vector_to_array("parts").alias("parts"))


@query
def pca_project(spark: SparkSession, d: str) -> DataFrame:
    """The first 12 components: uncorrelated, of falling variance, and within the total."""
    names = [f"p{i}" for i in range(12)]
    parts = stage(rows.spread_array(_components(spark, d, 12), "parts", names, "vec_id"), "parts")
    matrix = {(r["row"], r["col"]): r["covariance"] for r in numeric.covariance(parts, names).collect()}
    block = numeric.covariance(family_project(spark, d), E)
    total = block.where(F.col("row") == F.col("col")).agg(F.sum("covariance")).first()[0]
    variances = [matrix[n, n] for n in names]
    apart = all(abs(v) < 1e-9 * total for (a, b), v in matrix.items() if a != b)
    falling = all(x >= y for x, y in zip(variances, variances[1:], strict=False))
    checks = [(parts.count(), round(total, 6), apart, falling, 0 < sum(variances) <= total)]
    return spark.createDataFrame(
        checks, "rows bigint, total_variance double, uncorrelated boolean, falling boolean, within_total boolean"
    )


@query
def pca_norms(spark: SparkSession, d: str) -> DataFrame:
    """All components together keep the length of every row."""
    squares = F.aggregate("parts", F.lit(0.0), lambda a, x: a + x * x)
    return _components(spark, d, DIMENSIONS).select("vec_id", F.round(squares, 6).alias("squared_norm"))


@query
def pca_total_variance(spark: SparkSession, d: str) -> DataFrame:
    """All components together keep the total variance."""
    parts = _components(spark, d, DIMENSIONS)
    variances = parts.agg(*[F.var_samp(F.col("parts")[i]).alias(f"v{i}") for i in range(DIMENSIONS)])
    return variances.select(F.round(sum((F.col(f"v{i}") for i in range(DIMENSIONS)), F.lit(0.0)), 6).alias("variance"))


# ---- feature stages


def _feature_summary(features: DataFrame) -> DataFrame:
    values = vector_to_array("features")
    block = F.slice(values, 2, DIMENSIONS)
    one_hot = [
        column
        for c in ("lang", "source")
        for column in (
            (F.array_position(vector_to_array(f"{c}_enc"), 1.0) - 1).alias(f"{c}_slot"),
            F.size(vector_to_array(f"{c}_enc")).cast("bigint").alias(f"{c}_width"),
        )
    ]
    add = lambda a, x: a + x
    return features.select(
        "doc_id",
        F.size(values).cast("bigint").alias("width"),
        F.round(values[0], 6).alias("amount"),
        F.round(F.aggregate(block, F.lit(0.0), add), 5).alias("block_total"),
        F.round(_weighted(block), 5).alias("block_weighted"),
        F.round(F.aggregate(values, F.lit(0.0), add), 5).alias("total"),
        *one_hot,
    )


@query
def features_fit_transform(spark: SparkSession, d: str) -> DataFrame:
    data = wide_documents(spark, d)
    path = scratch_path(spark, "fitted")
    fit_features(data, document_spec(components=None), median="exact").save(path)
    return _feature_summary(FittedFeatures.load(spark, path).transform(data))


@query
def features_compat(spark: SparkSession, d: str) -> DataFrame:
    data = wide_documents(spark, d)
    return _feature_summary(
        fit_features(data, document_spec(components=None), compat=True, median="exact").transform(data)
    )


@query
def features_joined_index(spark: SparkSession, d: str) -> DataFrame:
    data = wide_documents(spark, d)
    fitted = fit_features(data, document_spec(components=None), median="exact", labels_on_driver=10)
    return _feature_summary(fitted.transform(data))


@query
def features_sentinel(spark: SparkSession, d: str) -> DataFrame:
    data = wide_documents(spark, d)
    return _feature_summary(
        fit_features(data, document_spec(components=None), median="exact").transform(data, fill="sentinel")
    )


@query
def features_all_components(spark: SparkSession, d: str) -> DataFrame:
    """Fitted with all components, the block of a row keeps its length."""
    data = wide_documents(spark, d)
    fitted = fit_features(data, document_spec(components=DIMENSIONS), median="exact")
    values = vector_to_array("features")
    squares = F.aggregate(F.slice(values, 2, DIMENSIONS), F.lit(0.0), lambda a, x: a + x * x)
    return fitted.feature_table(data).select(
        "doc_id",
        F.size(values).cast("bigint").alias("width"),
        F.round(values[0], 6).alias("amount"),
        F.round(squares, 5).alias("block_squares"),
    )


@query
def features_with_components(spark: SparkSession, d: str) -> DataFrame:
    """The parts around the 12 components: width, amount, one-hot slots and label of a row."""
    data = wide_documents(spark, d)
    values = vector_to_array("features")
    one_hot = F.aggregate(F.slice(values, 14, F.size(values) - 13), F.lit(0.0), lambda a, x: a + x)
    return fit_features(data, document_spec()).feature_table(data).select(
        "doc_id",
        F.size(values).cast("bigint").alias("width"),
        F.round(values[0], 6).alias("amount"),
        one_hot.alias("slots"),
        F.exists(F.slice(values, 2, 12), lambda x: F.isnan(x) | (F.abs(x) > 1e6)).alias("bad_component"),
        F.col("toxic").cast("bigint").alias("toxic"),
    )


# ---- classifier


def _published_fit(spark: SparkSession, d: str) -> tuple[DataFrame, classifier.LogisticRegressionModel]:
    data = wide_documents(spark, d)
    features = stage(fit_features(data, document_spec()).feature_table(data), "features")
    return features, classifier.fit_balanced(features, "toxic", "doc_id", stage_rows=False).model


def _linear(model: classifier.LogisticRegressionModel):
    """The margin of ``features``, spelled out."""
    products = F.transform(
        vector_to_array("features"), lambda x, i: x * F.get(F.array(*[F.lit(float(w)) for w in model.coefficients]), i)
    )
    return F.aggregate(products, F.lit(float(model.intercept)), lambda a, x: a + x)


@query
def lr_fit_coefficients(spark: SparkSession, d: str) -> DataFrame:
    """After ten iterations: the number of weights, a balanced loss below that of the zero model, and scores that follow
    from the weights."""
    features, model = _published_fit(spark, d)
    balanced, _ = balance.balance_classes(features, "toxic", "doc_id")
    scored = classifier.score(model, balanced).withColumn("p", vector_to_array("probability")[1])
    found = scored.agg(
        F.avg(-F.log(F.when(F.col("toxic") == 1, F.col("p")).otherwise(1 - F.col("p")))).alias("loss"),
        F.max(F.abs(F.col("p") - 1 / (1 + F.exp(-_linear(model))))).alias("off"),
    ).first()
    checks = [(len(model.coefficients), found["loss"] <= 0.6931471805599453, found["off"] < 1e-9)]
    return spark.createDataFrame(checks, "weights bigint, loss_below_zero_model boolean, scores_follow boolean")


@query
def lr_fit_rates(spark: SparkSession, d: str) -> DataFrame:
    features = line_features(spark, d)
    model = classifier.fit_classifier(features, "open", "line_id", mode="none", stage_rows=False, **TO_CONVERGENCE)
    scored = classifier.unpack_probability(classifier.score(model, features), "kind", ("closed", "open"))
    return scored.select("kind", F.round("open", 5).alias("open")).distinct()


@query
def lr_fit_folded(spark: SparkSession, d: str) -> DataFrame:
    """Fitted on rows that stand for all with the same features and label: what they weigh, and their probability."""
    features = line_features(spark, d)
    fit = classifier.fit_balanced(
        features, "open", "line_id", mode="none", stage_rows=False, fold=True, **TO_CONVERGENCE
    )
    scored = classifier.unpack_probability(
        classifier.score(fit.model, balance.fold_rows(features.withColumnRenamed("open", "label"), "label"))
        .withColumn("id", F.struct("label", "weight")), "id", ("closed", "open")
    )
    return scored.select("id.label", F.col("id.weight").cast("bigint").alias("rows"), F.round("open", 5).alias("open"))


@query
def lr_fit_weighted_rates(spark: SparkSession, d: str) -> DataFrame:
    features = line_features(spark, d)
    model = classifier.fit_classifier(features, "open", "line_id", mode="weight", stage_rows=False, **TO_CONVERGENCE)
    scored = classifier.unpack_probability(classifier.score(model, features), "kind", ("closed", "open"))
    return scored.select("kind", F.round("open", 5).alias("open")).distinct()


@query
def lr_fit_moments(spark: SparkSession, d: str) -> DataFrame:
    """At the optimum, the fitted probabilities have the same mean product with every feature as the labels."""
    columns = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    data = table(spark, d, "lineitem").select(
        "l_orderkey", *columns, (F.col("l_linestatus") == "O").cast("int").alias("open")
    )
    spec = FeatureSpec(key="l_orderkey", label="open", blocks=(Block("n", columns),))
    features = stage(fit_features(data, spec, stage_rows=False).feature_table(data), "features")
    model = classifier.fit_classifier(features, "open", "l_orderkey", mode="none", stage_rows=False, **TO_CONVERGENCE)
    values = vector_to_array("features")
    probability = vector_to_array("probability")[1]
    moments = classifier.score(model, features).agg(
        F.avg(probability).alias("intercept"), *[F.avg(probability * values[i]).alias(c) for i, c in enumerate(columns)]
    )
    return moments.unpivot([], list(moments.columns), "feature", "moment").withColumn("moment", F.round("moment", 5))


@query
def lr_load_rates(spark: SparkSession, d: str) -> DataFrame:
    features = line_features(spark, d)
    path = scratch_path(spark, "classifier")
    artifacts.save_model(
        classifier.fit_classifier(features, "open", "line_id", mode="none", stage_rows=False, **TO_CONVERGENCE), path
    )
    scored = classifier.score(artifacts.load_classifier(path), features)
    return scored.select(
        "line_id", F.round(vector_to_array("probability")[1], 5).alias("open"), "predictions"
    )


@query
def lr_fit_report(spark: SparkSession, d: str) -> DataFrame:
    features = line_features(spark, d)
    model = classifier.fit_classifier(features, "open", "line_id", mode="none", stage_rows=False, **TO_CONVERGENCE)
    report = classifier.summary_report(model.summary, features)
    return report.withColumn("value", F.round("value", 6))


@query
def lr_evaluate(spark: SparkSession, d: str) -> DataFrame:
    features = line_features(spark, d)
    model = classifier.fit_classifier(features, "open", "line_id", mode="none", stage_rows=False, **TO_CONVERGENCE)
    # Rounding joins the equal scores of a kind.
    return classifier.evaluate(model, features, "open").withColumn("value", F.round("value", 6))


@query
def lr_save_load_score(spark: SparkSession, d: str) -> DataFrame:
    """Scores of the loaded model: equal to the saved one's, to the logistic of the margin, and to the threshold."""
    features, model = _published_fit(spark, d)
    path = scratch_path(spark, "classifier")
    artifacts.save_model(model, path)
    parts = lambda m, name: classifier.score(m, features).select(
        "doc_id", vector_to_array("rawPrediction")[1].alias(f"{name}_raw"),
        vector_to_array("probability")[1].alias(f"{name}_p"), F.col("predictions").alias(f"{name}_predicted"),
    )
    both = parts(artifacts.load_classifier(path), "loaded").join(parts(model, "saved"), "doc_id")
    return both.select(
        "doc_id",
        (F.col("loaded_p") == F.col("saved_p")).alias("same"),
        (F.abs(F.col("loaded_p") - 1 / (1 + F.exp(-F.col("loaded_raw")))) < 1e-12).alias("logistic"),
        ((F.col("loaded_p") > classifier.THRESHOLD).cast("double") == F.col("loaded_predicted")).alias("threshold"),
    )


@query
def lr_score_fixed(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        min_max("o_totalprice", 0.0, 500000.0).alias("price"),
        F.length("o_orderpriority").cast("double").alias("priority"),
    )
    probability = logistic(["price", "priority"], [2.5, -0.25], 0.75)
    return orders.select(
        "o_orderkey",
        F.round(probability, 9).alias("probability"),
        (probability > classifier.THRESHOLD).cast("double").alias("predictions"),
    )


@query
def probability_unpack(spark: SparkSession, d: str) -> DataFrame:
    share = F.col("o_totalprice") / 500000.0
    vectors = table(spark, d, "orders").select(
        "o_orderkey", array_to_vector(F.array(1 - share, share)).alias("probability")
    )
    return classifier.unpack_probability(vectors, "o_orderkey", ("not_f", "f")).select(
        "o_orderkey", F.round("not_f", 9).alias("not_f"), F.round("f", 9).alias("f")
    )


@query
def submission_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    features = line_features(spark, d)
    model = classifier.fit_classifier(features, "open", "line_id", mode="none", stage_rows=False, **TO_CONVERGENCE)
    path = scratch_path(spark, "submission")
    tables.write_csv(classifier.submission(model, features, "line_id", "open"), path)
    return tables.read_csv(spark, path, {"open": T.DoubleType()}).withColumn("open", F.round("open", 5))


@query
def train_and_score_files(spark: SparkSession, d: str) -> DataFrame:
    """CSV to features, classifier, features of new rows and submission, through files only."""
    at = scratch_path(spark, "files")
    spec = document_spec()
    documents = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    details = wide_documents(spark, d).drop("lang", "source", "n_chars", "quality")
    tables.write_csv(documents, f"{at}/facts")
    tables.write_csv(details.dropna(how="all", subset=["toxic", *E]), f"{at}/details")
    jobs.build_training_features(spark, spec, f"{at}/facts", f"{at}/details", f"{at}/train", f"{at}/state")
    jobs.train(spark, f"{at}/train", "toxic", "doc_id", f"{at}/model", f"{at}/report", f"{at}/curve")
    jobs.build_scoring_features(spark, f"{at}/facts", f"{at}/details", f"{at}/state", f"{at}/score")
    jobs.score_to_csv(spark, f"{at}/score", f"{at}/model", "doc_id", "toxic", f"{at}/submission")
    scored = tables.read_csv(spark, f"{at}/submission", {"doc_id": T.LongType(), "toxic": T.DoubleType()})
    return scored.select("doc_id", F.col("toxic").between(0, 1).alias("is_probability"))


@query
def files_to_submission(spark: SparkSession, d: str) -> DataFrame:
    """The four jobs on orders: fitted to convergence, the submission holds the share of positives per kind."""
    at = scratch_path(spark, "orders-jobs")
    spec = FeatureSpec(key="o_orderkey", label="finished", categories=("o_orderpriority",))
    orders = table(spark, d, "orders")
    tables.write_csv(orders.select("o_orderkey", "o_orderpriority"), f"{at}/facts")
    finished = (F.col("o_orderstatus") == "F").cast("int").alias("finished")
    tables.write_csv(orders.select("o_orderkey", finished), f"{at}/details")
    jobs.build_training_features(spark, spec, f"{at}/facts", f"{at}/details", f"{at}/train", f"{at}/state")
    jobs.train(
        spark, f"{at}/train", "finished", "o_orderkey", f"{at}/model", f"{at}/report", f"{at}/curve",
        mode="none", **TO_CONVERGENCE,
    )
    jobs.build_scoring_features(spark, f"{at}/facts", f"{at}/details", f"{at}/state", f"{at}/score")
    jobs.score_to_csv(spark, f"{at}/score", f"{at}/model", "o_orderkey", "finished", f"{at}/submission")
    scored = tables.read_csv(spark, f"{at}/submission", {"o_orderkey": T.LongType(), "finished": T.DoubleType()})
    return scored.withColumn("finished", F.round("finished", 5))


@query
def train_curve(spark: SparkSession, d: str) -> DataFrame:
    """The curve that the training job writes for orders, whose scores are the shares of positives per kind."""
    at = scratch_path(spark, "curve-job")
    spec = FeatureSpec(key="o_orderkey", label="finished", categories=("o_orderpriority",))
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("finished")
    )
    tables.write_parquet(fit_features(orders, spec).feature_table(orders), f"{at}/train")
    jobs.train(
        spark, f"{at}/train", "finished", "o_orderkey", f"{at}/model", f"{at}/report", f"{at}/curve", mode="none", **TO_CONVERGENCE
    )
    curve = tables.read_csv(spark, f"{at}/curve", {"FPR": T.DoubleType(), "TPR": T.DoubleType()})
    return curve.select(F.round("FPR", 9).alias("FPR"), F.round("TPR", 9).alias("TPR"))


# ---- metrics


def _matrix(spark: SparkSession, d: str) -> DataFrame:
    return metrics.confusion_matrix(scored_events(spark, d), "label", "prediction")


@query
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return _matrix(spark, d)


@query
def label_list(spark: SparkSession, d: str) -> DataFrame:
    return metrics.label_list(labelled_documents(spark, d), "toxic")


@query
def accuracy(spark: SparkSession, d: str) -> DataFrame:
    return metrics.accuracy(_matrix(spark, d)).withColumn("accuracy", F.round("accuracy", 9))


@query
def metrics_by_label(spark: SparkSession, d: str) -> DataFrame:
    rates = metrics.rates_by_label(_matrix(spark, d))
    return rates.select("label", *[F.round(c, 9).alias(c) for c in rates.columns if c != "label"])


@query
def metrics_report(spark: SparkSession, d: str) -> DataFrame:
    report = metrics.metrics_report(scored_events(spark, d), "label", "prediction", "score")
    path = scratch_path(spark, "report")
    tables.write_parquet(report, path)
    return tables.read_parquet(spark, path).withColumn("value", F.round("value", 9))


@query
def roc_curve(spark: SparkSession, d: str) -> DataFrame:
    curve = roc.roc_curve(scored_events(spark, d), "label", "score")
    return curve.select(F.round("FPR", 9).alias("FPR"), F.round("TPR", 9).alias("TPR"))


@query
def roc_curve_bounded(spark: SparkSession, d: str) -> DataFrame:
    """At most 104 points of the exact curve, and by how much the area of the step to each may be off."""
    curve = roc.bounded_curve(scored_events(spark, d), "label", "score")
    return curve.select(F.round("FPR", 9).alias("FPR"), F.round("TPR", 9).alias("TPR"), F.round("bound", 9).alias("bound"))


@query
def auc_exact(spark: SparkSession, d: str) -> DataFrame:
    area = roc.area_under_roc(scored_events(spark, d), "label", "score")
    return area.select(F.round("area", 9).alias("area"))


@query
def auc_from_curve(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "curve")
    tables.write_csv(roc.roc_curve(scored_events(spark, d), "label", "score"), path)
    curve = tables.read_csv(spark, path, {"FPR": T.DoubleType(), "TPR": T.DoubleType()})
    return roc.area_under_curve(curve).select(F.round("area", 9).alias("area"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Join, features, balancing, fit and training metrics."""
    data = wide_documents(spark, d)
    features = stage(fit_features(data, document_spec()).feature_table(data))
    model = classifier.fit_classifier(features, "toxic", "doc_id", stage_rows=False)
    return classifier.summary_report(model.summary, data)
