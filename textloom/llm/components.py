"""Connected components of a graph given as a table of edges, by alternating stars.

Each round hangs every node on the smallest node near it, first among larger neighbours, then
among smaller ones, until all nodes of a component hang on its smallest node. Every step is a
grouped minimum, which is combined before the shuffle, and a join; each round is written to the
shared folder, so that lost executors never cost more than one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.plans.session import staged


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a"))
    least = down.groupBy("b").agg(F.min("a").alias("m"))
    near = down.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return near.unionByName(least.select(F.col("m").alias("a"), "b"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of the edges (``a``, ``b``); the root is the smallest node.

    Loops and edges with a null end are left out; repeated edges count once; no edges give no rows.
    """
    edges = edges.select("a", "b").where("a <> b").distinct()
    seen = None
    while True:
        edges = staged(_small_star(_large_star(edges)).where("a <> b").distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
