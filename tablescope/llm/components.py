"""Connected components of a graph given as edges, by large-star and small-star steps.

Each step is two shuffles over the edges.  A step hands every node's
neighbours to the smallest of them, so hubs shrink instead of being gathered,
and the smallest neighbour is found by a combined aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Scratch


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    around = _both(edges)
    low = around.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return around.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node with an edge to another; the root is the smallest node of the component."""
    scratch = Scratch(edges.sparkSession)
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = scratch.keep(pairs), None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == before or not state["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
        large = scratch.keep(_large_star(now))
        small = scratch.keep(_small_star(large))
        scratch.drop(now)
        scratch.drop(large)
        now = small
