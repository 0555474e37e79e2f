"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stash


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one edge at most to a smaller one, and that one none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of undirected edges (a, b); component is its least node.

    Each round ties the larger neighbours of every node to its least one, then the smaller ones,
    until edges lead from each node straight to the least one.  A round is
    two aggregations that combine before the shuffle and two joins whose hot keys AQE splits, and
    is written out, so lineage stays short.  Self-links and repeated links do no harm.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stash(edges.distinct(), "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stash(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        edges = stash(small.distinct(), "links")
    tied = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return tied.unionByName(tied.select(F.col("component").alias("node"), "component").distinct())


def merged(of: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after links (a, b) between components of ``of``; nodes not in it are their own."""
    joined = components(links)
    if of is None:
        return joined
    new = joined.select(F.col("node").alias("component"), F.col("component").alias("least"))
    old = of.join(new, "component", "left").select("node", F.coalesce("least", "component").alias("component"))
    return old.unionByName(joined.join(of.select("node"), "node", "left_anti"))
