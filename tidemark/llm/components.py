"""Connected components of an edge table, by alternating large-star and small-star steps
(Kiveris et al., 2014). Everything stays distributed and narrow: two longs per row.

A node's smallest neighbour is a map-side combined ``min``; the joins that hand it out
are plain equi-joins, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, parts, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: all larger neighbours of a node get its smallest one (or itself).
    Small star: the smaller neighbours of a node, and the node, get the smallest one."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    out = both.join(least, "a")
    if large:
        out = out.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node of its component.

    ``edges`` has long columns a and b. Loops, repeated and empty edges are fine.
    """
    edges, n = packed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before, now = None, (n, None)
    while n and now != before:  # at the fixed point each node points at its root
        before = now
        # No step makes more edges than nodes and edges: as many tasks as these need.
        width = parts(now[0])
        large = _star(edges, large=True).coalesce(width)
        edges = stage(_star(large, large=False).coalesce(width).distinct()).coalesce(width)
        now = state(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
