"""Connected components by rounds of joins, for graphs that no machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwarden.runtime import cut


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (smallest node reachable) for every node of an edge; alternating large and small stars.

    Every round writes its edges to the shared folder once. Minima are combined before the shuffle, so a node with
    very many edges costs its tasks one row each. Rounds end when every node has one smaller neighbour and no such
    neighbour has one of its own.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    current = cut(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _is_stars(current):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour is tied to the least one
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: the smaller neighbours, and the node itself, are tied to the least one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        current = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _is_stars(edges: DataFrame) -> bool:
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    nodes = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return nodes.where("below > 1 or (below = 1 and above = 1)").isEmpty()


def joined(components: DataFrame, edges: DataFrame) -> DataFrame:
    """``components`` (node, component) with the edges (a, b) added; only their graph, not the nodes', is gone through."""
    def placed(side):
        known = components.select(F.col("node").alias(side), F.col("component").alias("c" + side))
        return edges.select("a", "b").join(known, side, "left").select(
            "a", "b", F.coalesce("c" + side, side).alias("c" + side))

    both = cut(placed("a").join(placed("b"), ["a", "b"]), "component-edges")
    merged = cut(connected(both, "ca", "cb"), "components")
    nodes = components.unionByName(both.select(F.col("a").alias("node"), F.col("ca").alias("component"))).unionByName(
        both.select(F.col("b").alias("node"), F.col("cb").alias("component"))).distinct()
    root = merged.select(F.col("node").alias("component"), F.col("component").alias("root"))
    return cut(nodes.join(root, "component", "left").select(
        "node", F.coalesce("root", "component").alias("component")), "components")
