"""Connected components of an edge table, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import dropped, written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """edges: u > v. Each node's neighbours are hung under the least of them and the node itself: the greater ones
    (large) or the smaller ones and the node (small). Minima are combined before the shuffle, so hubs don't gather."""
    both = edges.select("u", "v")
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """node, root: the least node of its component, for each node that has an edge to another one."""
    edges = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u <> v").distinct()
    edges = written(edges, "edges")
    state = None
    while True:
        before, edges = edges, written(_stars(_stars(edges, True), False), "edges")
        dropped(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:  # nothing moved: all edges lead to roots
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
