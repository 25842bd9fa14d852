"""Connected components of a graph of any size, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_least"))
    larger = both.where(F.col("b") > F.col("a")).join(least, "a")
    return larger.select(F.col("b").alias("a"), F.least("a", "_least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("_least"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("_least"))
    return moved.select(F.col("b").alias("a"), F.col("_least").alias("b")).unionByName(
        least.select("a", F.col("_least").alias("b"))
    )


def component_roots(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``edges (a, b)``: the smallest node reachable. Roots have no row of their own.

    Nulls and links of a node to itself count for nothing; without edges the result is empty. Only minima are taken of
    a node's neighbours, never a list, and each round is written, so a node with very many links fills no task's memory.
    """
    current = stage(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
        .distinct(),
        "edges",
    )

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = mark(current)
    while before[0]:
        current = stage(_small_star(_large_star(current)).distinct(), "edges")
        after = mark(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
