from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from evenkeel.llm import mixing, packing, queries, quality, simhash, toxicity
from evenkeel.staging import stage

SF = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, results = docs.columns, {"documents": docs}
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = stage(step(spark, docs, SF), name)
        results[name] = docs
        if name != "packed":
            assert docs.columns == columns
        if name in ("quality", "toxicity", "distinct"):
            assert docs.exceptAll(before).count() == 0
    ids = {n: {r["doc_id"] for r in d.select("doc_id").collect()} for n, d in results.items()}
    good = {
        r["doc_id"] for r in quality.score_documents(
            results["documents"], spark.read.parquet(f"{SF}/labels.parquet")
        ).collect() if r["predicted"]
    }
    assert ids["quality"] == good
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    fine = [d for d in ids["quality"] if d in labels and labels[d]["toxic"] == 0]
    assert sum(d in ids["toxicity"] for d in fine) >= 0.98 * len(fine)
    fingerprints = simhash.near_duplicates(results["toxicity"]).collect()
    assert ids["distinct"] == {r["component_id"] for r in fingerprints}
    taken = Counter()
    for r in mixing.mix(results["distinct"]).collect():
        taken[r["doc_id"]] += r["taken"]
    words = Counter()
    for r in results["mixed"].select("doc_id", mixing.words("text").alias("n")).collect():
        words[r["doc_id"]] += r["n"]
    assert words == Counter({d: n for d, n in taken.items() if n})
    packed = results["packed"].collect()
    totals = Counter()
    for r in packed:
        totals[r["sequence_id"]] += r["length"]
    assert max(totals.values()) <= 1024 and sum(totals.values()) > 0.97 * 1024 * len(totals)
    rows = Counter(r["doc_id"] for r in packed if r["start"] == 0)
    assert rows == Counter(r["doc_id"] for r in results["mixed"].collect())
    assert np.all([r["length"] <= r["doc_tokens"] for r in packed])


def test_registered(spark):
    found = entry_points.queries()
    assert found["pipeline"] is corpus_pipeline.run and queries.QUERIES.items() <= found.items()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES) and corpus_pipeline.ORACLE_SQL is None
    assert toxicity.HOLDOUT.modulus == 5


#: Names that the stages use inside, as extra columns of the documents.
INSIDE = [
    "row", "item", "key", "_row", "_doc", "_source", "_size", "_group", "group", "size", "shard", "quota", "block", "blocks",
    "shift", "longer", "copies", "start", "_at", "_words", "_spans", "_cut", "_some", "_every", "_more", "_tokens", "code",
    "component_id", "fingerprint", "_copy", "_text", "demand", "length", "rank", "target", "_part", "_key",
]


def in_files(spark, path, files=40):
    spark.read.parquet(f"{SF}/documents.parquet").repartition(files).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("step", [simhash.distinct_documents, mixing.mixed_documents])
def test_change_of_cores(spark, tmp_path, step):
    """Files are cut differently when the number of cores changes between building a stage and reading it."""
    docs = in_files(spark, f"{tmp_path}/docs")
    expected = Counter(map(tuple, step(docs).collect()))
    before = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    try:
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "4")
        built = step(spark.read.parquet(f"{tmp_path}/docs"))
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "64")
        assert Counter(map(tuple, built.collect())) == expected
    finally:
        if before is None:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        else:
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", before)


def test_clashing_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 200")
    more = docs.selectExpr("*", *[f"'own' as `{c}`" for c in INSIDE])
    for step in (simhash.distinct_documents, mixing.mixed_documents):
        found = step(more)
        assert found.columns == more.columns
        assert found.where(" or ".join(f"`{c}` <> 'own'" for c in INSIDE)).count() == 0
        assert Counter(map(tuple, found.select(docs.columns).collect())) == Counter(map(tuple, step(docs).collect()))
    assert Counter(map(tuple, mixing.mix(more).collect())) == Counter(map(tuple, mixing.mix(docs).collect()))
    items = more.selectExpr("*", "n_chars as tokens")
    packed = packing.pack(items, {"tokens": 50_000})
    assert packed.columns == [*items.columns, "sequence_id", "offset"] and packed.count() == items.count()
    with pytest.raises(ValueError):
        packing.pack(packed, {"tokens": 50_000})


def test_empty_documents(spark, tmp_path):
    """An empty table goes through the last three stages; the first two need labelled rows to learn from."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES[2:]:
        docs = step(spark, docs, SF)
        assert docs.count() == 0
