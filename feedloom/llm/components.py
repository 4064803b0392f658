"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import pinned


def _stamp(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (``a``, ``b``); the component is its smallest node.

    Each round links all neighbours of a node to the smallest one; the rounds end when the stars
    no longer change. Nothing is gathered: minima are combined ahead of the shuffle and hubs meet them in a join.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    edges = pinned(edges, "edges")
    seen = _stamp(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # Large star: greater neighbours move to the smallest.
        large = both.filter("b > a").join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = pinned(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = _stamp(edges)
        if now == seen:
            break
        seen = now
    stars = edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))
