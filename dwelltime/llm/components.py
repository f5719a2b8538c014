"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwelltime.llm.tables import keep_table


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of links (a, b) of longs; a component is named by its smallest node.

    Loops and repeated links do no harm; without links the result is empty. Each step is one grouping and one join
    and is written to the shared folder; a node with very many links meets them as one row per task and minimum.
    """
    state, before = keep_table(edges.where("a <> b").select("a", "b").distinct(), "stars"), None
    while True:
        now = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
        for star in (_large, _small):
            state = star(state).where("a <> b").distinct()
        state = keep_table(state, "stars")
    return (state.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
