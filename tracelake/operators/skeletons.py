"""Nodes of trees in space: (tree, node, parent, coordinates) as they come from a reader of skeletons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.shared import cut

AXES = ("x", "y", "z")
#: Kinds of coordinates by the suffix of their columns.
SUFFIX = {"raw": "", "smooth": "_s", "pixel": "_pix"}


def smoothed(nodes: DataFrame, span: int, axes: tuple[str, ...] = AXES) -> DataFrame:
    """Add <axis>_s: the mean of `span` (made odd) nodes around each in order of ids, of fewer, evenly, at the ends of a tree.

    Every mean is of its own frame, so long trees lose no digits; null coordinates don't count. A tree is one window.
    """
    by = Window.partitionBy("tree")
    order = by.orderBy("node")
    half = (span - 1) // 2
    rows = nodes.withColumns({"_i": F.row_number().over(order) - 1, "_n": F.count(F.lit(1)).over(by)})
    reach = F.least(F.lit(half), F.col("_i"), F.col("_n") - 1 - F.col("_i"))
    means = {f"{a}_s": F.coalesce(*[F.when(reach == k, F.avg(a).over(order.rowsBetween(-k, k))) for k in range(half + 1)]) for a in axes}
    return rows.withColumns(means).drop("_i", "_n")


def in_pixels(nodes: DataFrame, sizes: dict[str, float], kind: str = "raw") -> DataFrame:
    """Add <axis>_pix: coordinates of a kind over the size of a voxel along each axis; null where that is zero."""
    return nodes.withColumns({f"{a}_pix": F.try_divide(F.col(a + SUFFIX[kind]), F.lit(float(size))) for a, size in sizes.items()})


def coordinates(nodes: DataFrame, kind: str, axes: tuple[str, ...] = AXES) -> DataFrame:
    """Tree, node, parent and the coordinates of a kind (raw, smooth or pixel) under the axes' own names."""
    return nodes.select("tree", "node", "parent", *[F.col(a + SUFFIX[kind]).alias(a) for a in axes])


def without_zero_lengths(nodes: DataFrame, axes: tuple[str, ...] = AXES) -> DataFrame:
    """Nodes that don't lie where their parent does; the children of those that do go to the next node above that stays.

    Ways up through dropped nodes double in each round, so a run of n of them takes about log2(n) rounds; a node without a
    coordinate stays. Other columns are kept. Raises ValueError where parents form a circle of one place.
    """
    above = nodes.select("tree", F.col("node").alias("parent"), *[F.col(a).alias(f"_{a}") for a in axes])
    same = F.coalesce(F.expr(" AND ".join(f"{a} = _{a}" for a in axes)), F.lit(False))
    gone = cut(nodes.join(above, ["tree", "parent"]).where(same).select("tree", "node", F.col("parent").alias("to")))
    links, rounds = gone, 0
    total = gone.count()
    while total:
        beyond = links.select("tree", F.col("node").alias("to"), F.col("to").alias("_to"))
        links = cut(links.join(beyond, ["tree", "to"], "left").select("tree", "node", F.coalesce("_to", "to").alias("to"), F.col("_to").isNotNull().alias("moved")))
        if not links.where("moved").count():
            break
        links, rounds = links.drop("moved"), rounds + 1
        if 1 << rounds > 2 * total:
            raise ValueError("parents form a circle of nodes in one place")
    way = links.select("tree", F.col("node").alias("parent"), "to")
    left = nodes.join(gone.select("tree", "node"), ["tree", "node"], "left_anti")
    return left.join(way, ["tree", "parent"], "left").withColumn("parent", F.coalesce("to", "parent")).select(*nodes.columns)
