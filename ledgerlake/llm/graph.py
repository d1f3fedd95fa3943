"""Connected components of links, in rounds of distributed star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.sources.workspace import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest node around it."""
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    least = (both.groupBy("a").agg(F.min("b").alias("m"))
             .select("a", F.least("a", "m").alias("m")))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, point to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): the smallest node it is connected with.

    Each round leaves stars with fewer centres; it ends when a round changes nothing. A node with
    very many links is a hot key of a plain join, which Spark splits; no task holds its neighbours.
    """
    now = written(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
                  .filter("a <> b").distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"),
                       F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == before:
            break
        before = mark
        now = written(_small_star(_large_star(now).distinct()).distinct(), "stars")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
