"""Mixing sources to target weights by Sainte-Laguë apportionment. DataFrame functions only.

Targets share the corpus by weight, up to a multiple of each source's own size. They are turned into equal-token blocks:
block by block the source with the highest quotient ``target / (2 k + 1)`` gets the next, ``k`` being those it has. A
source's blocks go to its shards in the same way, by the words they hold. A shard is a stream of documents in seeded
order cut into blocks; it takes its quota by stepping through them from a seeded start, so every block is taken equally
often or once more. Where a document's words lie in the stream is all that is needed to know how many are taken.

Shards grow in number with the corpus, not in size. Repeated rows are counted before anything is shuffled by source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import WORD, attach, identified, slots
from evenkeel.staging import stage

WEIGHTS = (5, 2, 1)
CEILING = 3
SEED = 42
BLOCK_WORDS = 512
LEAST_BLOCKS = 400
SHARD_WORDS = 2_000_000
SHARD_ROWS = 100_000


def words(text: str) -> Column:
    """Number of words; null texts have none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: str) -> Column:
    """The source as text that is never null, in the order of code points with null last."""
    return F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("1"))


def _draw(*parts: Column | str) -> Column:
    """A 60-bit number from the seeded parts."""
    text = F.concat_ws(":", *[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """``(_source, source_size, rows, rank, target)`` for ``sizes (_source, size)``.

    Sources in order weigh ``weights``, repeating. Those for which the ceiling is the least for their weight stop there;
    the rest share what is left by weight. One row per source is ordered in one task.
    """
    sources = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy("_source")) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights))) + 1)
    limited = ranked.withColumns({"_weight": weight, "_limit": F.col("source_size") * F.lit(ceiling)})
    by_need = Window.orderBy(F.col("_limit") / F.col("_weight"), "rank")
    onward = by_need.rowsBetween(0, Window.unboundedFollowing)
    shared = limited.withColumns({
        "_words": F.sum("source_size").over(Window.partitionBy()) - F.coalesce(
            F.sum("_limit").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
        "_weights": F.sum("_weight").over(onward),
    }).withColumn("_stops", F.col("_limit") * F.col("_weights") <= F.col("_words") * F.col("_weight"))
    # What is left for a unit of weight, as the first source that does not stop sees it.
    level = F.struct("_words", "_weights")
    whole = Window.partitionBy()
    levelled = shared.withColumn(
        "_level",
        F.min_by(
            F.when(~F.col("_stops"), level),
            F.when(~F.col("_stops"), F.struct(F.col("_limit") / F.col("_weight"), "rank")),
        ).over(whole),
    )
    target = F.when(F.col("_stops"), F.col("_limit").cast("double")).otherwise(
        F.col("_weight") * F.col("_level._words") / F.col("_level._weights")
    )
    return levelled.select("_source", "source_size", "rows", "rank", target.alias("target"))


def apportion(
    claims: DataFrame, seats: Column, votes: str, within: list[str], order: list[str], name: str
) -> DataFrame:
    """``claims`` with the whole number of seats of each in column ``name``, by the highest quotients ``votes / (2 k + 1)``.

    ``seats`` is the number to give out in each group of ``within``; equal quotients go by ``order``. Only quotients
    near the proportional share can decide: by the divisor's bounds a share is missed by half the claims' part at most.
    """
    group = Window.partitionBy(*within)
    total, parties = F.sum(votes).over(group), F.sum(F.when(F.col(votes) > 0, 1).otherwise(0)).over(group)
    share = F.when(total > 0, F.col(votes) * F.col("_seats") / total).otherwise(F.lit(0.0))
    bounded = claims.withColumn("_seats", seats).withColumns({"_share": share, "_parties": parties}).withColumn(
        "_slack", F.when(
            F.col("_seats") > 0, F.ceil(F.col("_share") * F.col("_parties") / (2 * F.col("_seats")))
        ).otherwise(F.lit(0)) + 1
    ).withColumn("_sure", F.greatest(F.lit(0), F.floor("_share") - F.col("_slack")).cast("long"))
    open_seats = bounded.withColumn("_open", F.col("_seats") - F.sum("_sure").over(group))
    tried = open_seats.where((F.col(votes) > 0) & (F.col("_seats") > 0)).withColumn(
        "_k", F.explode(F.sequence(F.col("_sure"), (F.floor("_share") + F.col("_slack")).cast("long")))
    )
    best = Window.partitionBy(*within).orderBy(F.desc(F.col(votes) / (2 * F.col("_k") + 1)), *order, "_k")
    won = tried.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= F.col("_open"))
    more = won.groupBy(*order).agg(F.count(F.lit(1)).alias("_more"))
    return open_seats.join(more, order, "left").withColumn(name, F.col("_sure") + F.coalesce("_more", F.lit(0))).select(
        *claims.columns, name
    )


def sized(
    documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", *kept: Column
) -> DataFrame:
    """``(doc_id, _source, size, _group)`` and the columns ``kept``; rows that agree in the first three share their
    ``_group``. Nothing else of ``documents`` is read, whatever its names."""
    rows = documents.select(
        F.col(key).cast("long").alias("doc_id"), _source_key(source).alias("_source"), words(text).alias("size"), *kept
    )
    group = F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "_source")))
    return rows.withColumn("_group", group)


def plan(
    rows: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    ceiling: int = CEILING,
    seed: int = SEED,
    block_words: int = BLOCK_WORDS,
    least_blocks: int = LEAST_BLOCKS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per ``_group`` of ``rows`` (as of ``sized``, a written table) with its number of ``copies``, where they
    start in their stream, and the stream's rule: ``quota`` of ``blocks`` blocks of ``block`` words, or one more in the
    first ``longer`` of them, from ``shift``.

    The block is at most ``block_words`` and small enough for ``least_blocks`` in the smallest target.
    """
    sources = stage(targets(rows, weights, ceiling), "targets")
    totals = sources.agg(
        F.sum("source_size"), F.sum("rows"), F.min(F.when(F.col("target") > 0, F.col("target")))
    ).first()
    all_words, all_rows, least = totals[0] or 0, totals[1] or 0, totals[2] or 0
    block = int(max(1, min(block_words, least // least_blocks)))
    shards = int(max(1, -(-all_words // shard_words), -(-all_rows // SHARD_ROWS)))

    place = _draw(F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("size").cast("string"))
    groups = rows.groupBy("_source", "doc_id", "size", "_group").agg(F.count(F.lit(1)).alias("copies")).withColumn(
        "_place", place
    )
    groups = stage(groups.withColumn("shard", F.pmod("_place", F.lit(shards)).cast("int")), "mix")

    quota_of = apportion(sources, F.lit(round(all_words / block)).cast("long"), "target", [], ["rank"], "source_blocks")
    held = groups.groupBy("_source", "shard").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    streams = held.join(quota_of.select("_source", "rank", "source_size", "target", "source_blocks"), "_source")
    dealt = apportion(streams, F.col("source_blocks"), "words", ["rank"], ["rank", "shard"], "quota")
    blocks = F.greatest(F.lit(1), F.round(F.col("words") / F.lit(block))).cast("long")
    rule = dealt.withColumn("blocks", blocks).withColumns({
        "quota": F.least(F.col("quota"), F.col("blocks") * F.lit(ceiling)),
        "shift": F.pmod(
            _draw(F.lit(str(seed)), F.lit("start"), F.col("rank").cast("string"), F.col("shard").cast("string")),
            F.col("blocks"),
        ),
    }).select(
        "_source", "shard", "source_size", "target", "quota", "blocks", "shift",
        F.floor(F.col("words") / F.col("blocks")).alias("block"), F.pmod("words", "blocks").alias("longer"),
    )
    stream = Window.partitionBy("_source", "shard").orderBy("_place", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = groups.withColumn("start", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(stream), F.lit(0)))
    return starts.join(rule, ["_source", "shard"])


def _steps(block: Column) -> Column:
    """Blocks taken before a block, and from the shift on."""
    return F.floor((block * F.col("quota") + F.col("shift")) / F.col("blocks")).cast("long")


def _block_at(position: Column) -> Column:
    """The block of a position; the first ``longer`` blocks have a word more."""
    in_longer = F.col("longer") * (F.col("block") + 1)
    later = F.col("longer") + F.floor((position - in_longer) / F.greatest(F.col("block"), F.lit(1)))
    return F.when(position < in_longer, F.floor(position / (F.col("block") + 1))).otherwise(later).cast("long")


def _times(block: Column) -> Column:
    """How often a block is taken."""
    return _steps(block + 1) - _steps(block)


def _taken_before(position: Column) -> Column:
    """Words the stream takes before a position."""
    at = _block_at(position)
    inside = position - at * F.col("block") - F.least(at, "longer")
    earlier = (_steps(at) - _steps(F.lit(0))) * F.col("block") + _steps(F.least(at, "longer")) - _steps(F.lit(0))
    return earlier + _times(at) * inside


def mix(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` per document; ``settings`` as for ``plan``.

    A null source is a source, the last one. Null and empty texts have size 0 and nothing taken. Rows that repeat are
    taken as often in all as any other words of their stream. Other columns are left out, whatever their names; an empty
    table gives an empty result.
    """
    at = F.col("start") + F.col("_copy") * F.col("size")
    planned = plan(stage(sized(documents, key, text, source), "sizes"), **settings)
    rows = planned.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return rows.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (_taken_before(at + F.col("size")) - _taken_before(at)).alias("taken"),
    )


def mixed_documents(
    documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **settings
) -> DataFrame:
    """The mix itself, in the columns of ``documents``: a row for each time a text is taken whole, and one with the
    words that are taken once more, if these are not all. ``n_chars``, if present, is brought up to date.

    Documents of which nothing is taken are not in the result, so neither are null texts, nor those without words. A null
    source is a source, repeated rows are taken each by itself, and columns may have any names. An empty table stays
    empty. Documents are told by their place in their files, which no re-run and no change of executors between two scans
    alters.
    """
    place = ["file", "at"]
    counted = identified(documents).select(*place, "item", F.col("item")[text].alias("text"))
    named = counted.select(*place, "text", F.col("item")[key].alias("key"), F.col("item")[source].alias("source"))
    rows = stage(sized(named, "key", "text", "source", *map(F.col, place)), "sizes")
    rule = ["copies", "start", "quota", "blocks", "shift", "block", "longer"]
    planned = stage(plan(rows, **settings).select("_group", *rule), "plan")
    found = stage(
        attach(rows.select(*place, "_group", "size"), planned, "_group", "copies", rows.count(), keep_copies=True), "picks"
    )
    once = found.where(F.col("copies") == 1).withColumn("_copy", F.lit(0).cast("long"))
    repeated = slots(found.where(F.col("copies") > 1), "_group", place, "_copy")
    picks = once.unionByName(repeated).where(F.col("size") > 0).select(
        *place, F.col("size").alias("_words"), (F.col("start") + F.col("_copy") * F.col("size")).alias("_at"), *rule[2:]
    )
    every = F.floor(F.col("quota") / F.col("blocks")).cast("int")
    end = F.col("_at") + F.col("_words")
    begin = lambda b: b * F.col("block") + F.least(b, F.col("longer"))
    spans = F.filter(F.sequence(_block_at(F.col("_at")), _block_at(end - 1)), lambda b: _times(b) > every)
    cut = F.transform(
        "_spans",
        lambda b: F.struct(
            F.greatest(begin(b) - F.col("_at"), F.lit(0)).alias("from"), F.least(begin(b + 1), end).alias("to")
        ),
    )
    tokens = F.regexp_extract_all(F.col("text"), F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), 0)
    part = lambda s: F.array_join(F.slice("_tokens", (s["from"] + 1).cast("int"), (s["to"] - F.col("_at") - s["from"]).cast("int")), "")
    some = F.aggregate("_cut", F.lit(0).cast("long"), lambda n, s: n + s["to"] - F.col("_at") - s["from"])
    taken = (
        counted.join(
            picks.withColumn("_every", every).withColumn("_spans", spans).withColumn("_cut", cut).withColumn(
                "_some", some
            ),
            place,
        )
        .where((F.col("_every") > 0) | (F.col("_some") > 0))
        .withColumn("_tokens", F.when((F.col("_some") > 0) & (F.col("_some") < F.col("_words")), tokens))
        .withColumn(
            "_more",
            F.when(F.col("_some") == F.col("_words"), F.col("text")).when(
                F.col("_some") > 0, F.array_join(F.transform("_cut", part), "")
            ),
        )
    )
    texts = F.array_compact(F.concat(F.array_repeat(F.col("text"), F.col("_every")), F.array("_more")))
    new = {text: F.col("_text")}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.length("_text").cast(documents.schema["n_chars"].dataType)
    exploded = taken.select("item", F.explode(texts).alias("_text"))
    return exploded.select(*[new.get(c, F.col("item")[c]).alias(c) for c in documents.columns])
