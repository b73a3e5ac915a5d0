"""Connected components by alternating large and small stars, as Spark joins.

Each round is two equi-joins on small rows; the neighbour minimum is aggregated
partially before its shuffle and written before it is joined, so that a centre with
very many neighbours is a skewed join that Spark splits. Nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges ``(a, b)`` in; each node's larger (smaller) neighbours linked to the least of all (smaller) ones."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))
    linked = both.where("b > a") if large else both
    out = linked.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a root that has none: then the edges are the answer."""
    several = edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
    inner = edges.select("b").distinct().join(edges.select("a"), F.col("a") == F.col("b"), "left_semi").select("b")
    return several.union(inner).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the least node it reaches."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    while not _settled(now):
        now = stored(_star(stored(_star(now, True)), False))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
