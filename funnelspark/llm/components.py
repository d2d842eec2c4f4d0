"""Connected components of a link table, by min-label contraction.

Edges are pairs of longs.  Each round links every node to the smallest node it
knows (large star), then every node's smaller neighbours to the smallest of
them (small star), until a round changes nothing; stars around their smallest
node remain.  Rounds are logarithmic in the longest chain in practice.  Every
round is a written table in the shared folder, and only a count and a checksum
reach the driver.  Minima are aggregated before the shuffle, and the join that
hands them back is an ordinary equi-join, which adaptive execution splits at a
hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(pairs: DataFrame) -> DataFrame:
    """(u, v): each v linked to the smallest of u and u's neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (columns a, b); the root is the
    smallest node of the component."""
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct(), "links")
    before = None
    while True:
        both = edges.selectExpr("a as u", "b as v").unionByName(edges.selectExpr("b as u", "a as v"))
        large = _star(both).where("a > b").distinct()
        small = _star(large.selectExpr("a as u", "b as v")).where("a > b")
        own = large.groupBy("a").agg(F.min("b").alias("b"))  # each node keeps its own smallest
        edges = written(small.unionByName(own).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
