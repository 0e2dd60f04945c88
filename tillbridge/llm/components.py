"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbridge.llm.common import Scratch


def _done(edges: DataFrame) -> bool:
    """Whether every node has one root, and no root is a node."""
    roots = edges.groupBy(F.col("root").alias("n")).agg(F.lit(0).alias("as_node"), F.lit(1).alias("as_root"))
    nodes = edges.groupBy(F.col("node").alias("n")).agg(F.count("*").alias("as_node"), F.lit(0).alias("as_root"))
    both = nodes.union(roots).groupBy("n").agg(F.sum("as_node").alias("as_node"), F.sum("as_root").alias("as_root"))
    return both.where("as_node > 1 OR as_node > 0 AND as_root > 0").isEmpty()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of (a, b) edges but the roots; a root is its component's least node.

    Every step joins neighbours with their least neighbour; the number of steps grows with the
    logarithm of the number of nodes.
    """
    edges = scratch.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct(),
        "edges")
    while not _done(edges):
        both = edges.select(F.col("node").alias("u"), F.col("root").alias("v")).union(edges.select("root", "node"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("m").alias("root")),
                              F.struct(F.col("v").alias("node"), F.col("m").alias("root")))).alias("e"))
        stars = scratch.keep(small.select("e.*").where("node <> root").distinct(), "stars")
        scratch.drop(edges)
        edges = stars
    return edges
