"""Connected components of an edge table by alternating stars, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_table


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (the smallest node reachable) for every node of an edge.

    Each round first connects a node's larger neighbours, then its smaller
    ones, to the smallest node of its neighbourhood; the edges converge to one
    star per component in a number of rounds that grows with the logarithm of
    the graph. The smallest neighbour is a partial aggregate, and the join with
    it reads two written tables, so a node with very many edges can be split.
    Loops, repeated edges and an empty table are allowed.
    """
    current = scratch_table(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == before:
            break
        before = tuple(state)
        current = scratch_table(_small_star(scratch_table(_large_star(current), "large")), "small")
    return (current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = scratch_table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return (edges.select(F.col("v").alias("u"), F.col("u").alias("far"))
            .join(least, "u").select(F.col("far").alias("u"), F.col("m").alias("v"))
            .where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = scratch_table(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
