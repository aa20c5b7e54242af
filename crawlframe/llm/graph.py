"""Connected components by alternating star contractions, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.shared import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the greater (``large``) or smaller neighbours of every node to the least one. Edges have u > v.

    The minimum is a partial aggregate. It is stored, and meets the edges again in a plain join of two stored tables, so that
    Spark can split the edges of a node with very many neighbours over tasks.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = store(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    joined = both.join(least, "u")
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its least node."""
    state = store(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        now = state.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
        state = store(_star(store(_star(state, True), "edges"), False), "edges")
    nodes = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
