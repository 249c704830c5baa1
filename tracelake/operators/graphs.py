"""Graphs that are DataFrames of edges: connected components, and paths to the roots of trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.shared import cut


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


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge; root is the least node that it reaches.

    edges: columns a and b of one ordered type; loops, repeats and nulls count for nothing. Alternates large and small
    stars until the edges stop changing, which takes rounds in the order of the logarithm of the graph's size; each round
    is checkpointed. Raises RuntimeError if most_rounds don't suffice.
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


def root_paths(nodes: DataFrame) -> DataFrame:
    """(node, depth, path) of every node that a root reaches; nodes: node and parent (null for roots). path begins at the root.

    By pointer doubling: every round joins each node's way up so far with that of where it ends, so a tree of depth n takes
    about log2(n) rounds, each checkpointed. Nodes on or below a cycle, or below an unknown parent, are left out.
    """
    ways = cut(nodes.select("node", F.col("parent").alias("up"), F.array("node").alias("path")))
    left = total = ways.where("up is not null").count()
    rounds = 0
    # No way up is longer than all nodes that have a parent; what is left after so many steps has no root.
    while left and (1 << rounds) <= 2 * total:
        above = ways.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        ways = cut(ways.where("up is null").unionByName(ways.where("up is not null").join(above, "up").select("node", F.col("_up").alias("up"), F.concat("_path", "path").alias("path"))))
        left, rounds = ways.where("up is not null").count(), rounds + 1
    return ways.where("up is null").select("node", (F.size("path") - 1).alias("depth"), "path")


def depths(nodes: DataFrame) -> DataFrame:
    """(node, root, depth) of every node that a root reaches, by pointer doubling as in root_paths but without the paths."""
    ways = cut(nodes.select("node", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.coalesce("parent", "node").alias("root")))
    left = total = ways.where("up is not null").count()
    rounds = 0
    while left and (1 << rounds) <= 2 * total:
        above = ways.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("root").alias("_root"))
        on = ways.where("up is not null").join(above, "up").select("node", F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_root").alias("root"))
        ways = cut(ways.where("up is null").unionByName(on))
        left, rounds = ways.where("up is not null").count(), rounds + 1
    return ways.where("up is null").select("node", "root", "depth")


def longest_paths(nodes: DataFrame) -> DataFrame:
    """(root, depth, path) of each tree's deepest node; of equally deep ones the least.

    Depths come first, without paths; then one path is followed for each root, by names of ancestors 1, 2, 4 ... steps up:
    of the nodes known to be on it, each adds the one so many steps above, longest steps first.
    """
    deep = cut(depths(nodes))
    ends = deep.groupBy("root").agg(F.min_by("node", F.struct(-F.col("depth"), "node")).alias("node"), F.max("depth").alias("depth"))
    jumps = [cut(nodes.where("parent is not null").select("node", F.col("parent").alias("above")))]
    most = ends.agg(F.max("depth")).first()[0] or 0
    while 1 << len(jumps) <= most:
        step = jumps[-1]
        jumps.append(cut(step.join(step.select(F.col("node").alias("above"), F.col("above").alias("_above")), "above").select("node", F.col("_above").alias("above"))))
    on_path = ends.select("root", "node", F.col("depth").alias("at"))
    for k in range(len(jumps) - 1, -1, -1):
        up = on_path.join(jumps[k], "node").select("root", F.col("above").alias("node"), (F.col("at") - (1 << k)).alias("at"))
        on_path = cut(on_path.unionByName(up))
    paths = on_path.groupBy("root").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "node"))), lambda x: x["node"]).alias("path"))
    return paths.select("root", (F.size("path") - 1).alias("depth"), "path")
