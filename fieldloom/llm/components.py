"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to its smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b) that isn't the smallest of its component.

    Rounds run until the edges are stars about the smallest node. Only minima
    are grouped by node, with partial aggregation; a node of very many links is
    a skewed join, which the planner splits. Nulls and self-links are ignored.
    """
    edges = links.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state = F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("h"))
    edges = materialize(edges, "edges")
    before = edges.agg(state.alias("s")).first()[0]
    while before["n"]:
        edges = materialize(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        after = edges.agg(state.alias("s")).first()[0]
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
