"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrycraft.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: hang the neighbours of every node (the larger ones, or the smaller ones) below its least one.

    The least neighbour is a grouping that combines before the shuffle; the join back keeps the many edges of
    a hub on the left, where AQE can split them.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sided = both if large else both.where("b < a")
    least = sided.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("low"))
    joined = sided.join(least, F.col("a") == F.col("node"))
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    below = joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return below.union(least.where("node <> low").select("node", "low")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its least node.

    Alternating large-star and small-star steps until the edges no longer change (Kiveris et al., "Connected
    components in MapReduce and beyond", 2014); rounds grow as the logarithm of the longest path. Each round is
    a table in the shared folder, so a lost executor repeats one round at most; the driver sees two numbers of it.
    Self-loops and NULL ends are ignored, repeated edges count once, no edges give no rows.
    """
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edges, seen = stage(edges, "edges"), None
    while True:
        edges = stage(_star(_star(edges, large=True), large=False), "edges")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
