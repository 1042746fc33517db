"""Connected components of a graph given by its edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.plans.staging import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = checkpointed(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")))
    return both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = checkpointed(edges.groupBy("a").agg(F.min("b").alias("low")))
    moved = edges.join(lowest, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(lowest.select("a", F.col("low").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of ``edges`` (two long columns); ``component`` is the smallest node reachable.

    Edges go either way; loops, repeats and nulls among them do no harm. Nodes without an edge to another are left
    out. Each round sends every node's larger neighbours, then its smaller ones, to the smallest of them, until all
    components are stars; the number of rounds grows with the logarithm of the longest path. A node's edges are
    never gathered: minima are aggregated before the shuffle, written, and joined back, so that AQE can split the join
    of a hub.
    """
    a, b = edges.columns
    # Each edge points from its larger node to its smaller one.
    current = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    current, before = checkpointed(current), None
    while True:
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 40) - 1))), F.sum(F.xxhash64("b", "a") % (1 << 31))
        ).first()
        if state == before or state[0] == 0:
            break
        before = state
        current = checkpointed(_small_star(_large_star(current).where("a != b").distinct()).distinct())
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
