"""Connected components of links by alternating stars, every step a join and a grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b), both bigint: root is the smallest node.

    Large stars hang the larger neighbours of a node on its smallest neighbour, small stars
    the smaller ones; both keep components whole, and the steps end when nothing changes,
    after about log2 of the longest path.  Each step is stored, so none repeats another.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges, seen = _stored(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, _ = _stored(large)
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        met = edges.join(low, "u")
        small = met.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, now = _stored(small.unionByName(low.select("u", F.col("m").alias("v"))))
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The distinct edges as a table, and what tells one set of edges from another."""
    edges = materialise(edges.distinct(), "stars")
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return edges, tuple(edges.agg(F.count("*"), mark).first())
