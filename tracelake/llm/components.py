"""Connected components of a graph that is a DataFrame of edges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import cut


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link each node's neighbours (its larger ones, or its smaller ones and itself) to the least node around it.

    The least is found by an aggregation with partial sums and joined back, so a hub's edges never meet in one task.
    """
    both = edges.select("a", "b") if not larger else edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.join(least, "a")
    if larger:
        return linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own).where("a <> b")


def connected_components(edges: DataFrame, most_rounds: int = 60, cut: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """(node, root) of every node with an edge; root is the least node that it reaches.

    edges: columns a and b of one ordered type; loops, repeats and nulls count for nothing. Alternates large and small
    stars until the edges stop changing, which takes rounds in the order of the logarithm of the graph's size; each round
    is checkpointed, or kept by another `cut`. Raises RuntimeError if most_rounds don't suffice.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(most_rounds):
        edges = cut(_star(_star(edges, True).distinct(), False).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        seen = now
    raise RuntimeError("connected components did not settle")
