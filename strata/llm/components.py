"""Connected components of an undirected graph by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of an edge with the smallest node it can reach.

    A round links the neighbours of each node to the smallest one: larger neighbours first, then smaller ones. The
    number of rounds grows with the logarithm of the longest path. Each round is written to the scratch folder, so
    lost executors repeat one round at most. A node's neighbours are never gathered: minima are aggregated and joined.
    """
    links = written(_distinct(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v")), "links")
    seen = None
    while True:
        links = written(_small_star(_large_star(links)), "links")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    # Unchanged by a round: every link leads to its root.
    roots = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _distinct(links: DataFrame) -> DataFrame:
    return links.groupBy("u", "v").agg(F.lit(0).alias("_")).drop("_")


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour or itself."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = links.select(F.col("v").alias("u"), F.col("u").alias("far")).join(least, "u")
    return _distinct(moved.select(F.col("far").alias("u"), F.col("m").alias("v")).where("u != v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node's smaller neighbours and the node itself are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return _distinct(moved.unionByName(least.select("u", F.col("m").alias("v"))))
