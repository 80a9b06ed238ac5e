"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from extractkit.llm.common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of every id in ``links`` (columns ``a``, ``b``), component being the smallest id reachable.

    Each step takes the smallest neighbour by a plain aggregate, which reduces before the
    shuffle, and joins it back to the edges, a join whose hot keys Spark can split.  No
    neighbour list is ever gathered.  Links of an id to itself and nulls are dropped; no links
    give no rows.  Each round is written to the shared scratch folder.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of an id points at the smallest id around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of an id, and the id itself, point at the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
