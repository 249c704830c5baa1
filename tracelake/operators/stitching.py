"""Trees in space joined into one: the nearest root is put below the nearest node, again and again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.shared import cut, stored
from tracelake.operators.graphs import depths

_AXES = ("x", "y", "z")


def _cells(reach: float, prefix: str = "") -> list:
    return [F.floor(F.col(f"{prefix}{c}") / reach) for c in _AXES]


def first_reach(roots: DataFrame, nodes: DataFrame, family: str, reach: float) -> float:
    """reach, halved until a node has on average no more than one root in its own cell, roots at the very place of nodes aside.

    A search within more would meet a number of pairs that grows with the square of the number of trees.
    """
    places = nodes.select(family, *_AXES, F.lit(0).alias("r"), F.lit(1).alias("n")).unionByName(roots.select(family, *_AXES, F.lit(1).alias("r"), F.lit(0).alias("n")))
    at = places.groupBy(family, *_AXES).agg(F.sum("r").alias("r"), F.sum("n").alias("n"))
    meet = lambda cells: cells.agg(F.sum(F.col("r").cast("double") * F.col("n")), F.sum("n")).first()
    same, total = meet(at)
    while total is not None and meet(at.groupBy(family, *_cells(reach)).agg(F.sum("r").alias("r"), F.sum("n").alias("n")))[0] > total + same:
        reach /= 2
    return reach


def near_nodes(roots: DataFrame, nodes: DataFrame, family: str, reach: float) -> DataFrame:
    """(family, child, host, node, d): the node of each other group that is nearest to a root, where within `reach` of it; of equally near ones the least by host and node.

    roots: family, tree, x, y, z; nodes: the same, node and root, the tree at the top of the node's group. Roots go to the 27
    cells around them, nodes to their own, so a node is sent once whatever the number of roots. The pairs of a root and a group
    meet as partial minima.
    """
    around = roots.select(family, F.col("tree").alias("child"), *[F.col(c).alias(f"r{c}") for c in _AXES])
    for c, cell in zip(_AXES, _cells(reach, "r")):
        around = around.withColumn(f"c{c}", F.explode(F.array(*[cell + i for i in (-1, 0, 1)])))
    placed = nodes.select(family, "root", F.col("tree").alias("host"), "node", *_AXES, *[cell.alias(f"c{c}") for c, cell in zip(_AXES, _cells(reach))])
    d = F.sqrt(sum(((F.col(c) - F.col(f"r{c}")) * (F.col(c) - F.col(f"r{c}")) for c in _AXES), F.lit(0.0)))
    pairs = around.join(placed, [family, "cx", "cy", "cz"]).where("child <> root").withColumn("d", d).where(F.col("d") <= reach)
    least = pairs.groupBy(family, "child", "root").agg(F.min(F.struct("d", "host", "node")).alias("least"))
    return least.select(family, "child", "least.host", "least.node", "least.d")


def _round(edges: DataFrame, groups: DataFrame, family: str) -> DataFrame:
    """The links (family, child, host, node, d, above) that greedy merging takes whatever becomes of the others.

    A root's least edge to another group is taken if it comes before the least edge of that group's own root: nothing can
    have moved that group by then. The least edge of all is always taken, and no cycle can arise.
    """
    at = groups.select(family, F.col("tree").alias("host"), F.col("root").alias("above"))
    still = groups.where("tree = root").select(family, F.col("tree").alias("child"))
    open_ = edges.join(still, [family, "child"]).join(at, [family, "host"]).where("above <> child")
    best = cut(open_.groupBy(family, "child").agg(F.min(F.struct("d", "child", "host", "node", "above")).alias("e")))
    rival = best.select(family, F.col("child").alias("above"), F.struct("e.d", "e.child").alias("other"))
    taken = best.select(family, "e.*").join(rival, [family, "above"], "left").where(F.col("other").isNull() | (F.struct("d", "child") < F.col("other")))
    return stored(taken.select(family, "child", "host", "node", "d", "above"))


def stitches(nodes: DataFrame, family: str, reach: float) -> DataFrame:
    """(family, child, host, node, d): tree `child` hangs by its root below `node` of tree `host`, d away.

    nodes: family, tree, node, parent (null for a tree's root), x, y, z. Of all pairs of a root and another tree the nearest
    is joined first, ties going by child, host and node; then the nearest of what is left, a joined root being no root any
    more and trees joined already no pair, until one root is left in each family. Distances are those to the nodes as given.
    Searches begin within `reach`, or a half, a quarter ... of it where trees are crowded (see first_reach), and double it, which
    changes no result: all shorter links are settled by then. Roots that are left are farther than that from all other groups, so
    only so many of them fit around a node and pairs grow as the nodes do. Families, trees or coordinates that are null or NaN
    are never joined; a tree of several roots counts by its least node among them.
    """
    whole = nodes.where(F.col(family).isNotNull() & F.col("tree").isNotNull() & F.col("node").isNotNull())
    placed = whole
    for c in _AXES:
        placed = placed.withColumn(c, F.col(c).cast("double")).where(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    placed = stored(placed.select(family, "tree", "node", "parent", *_AXES))
    roots = stored(placed.where("parent is null").groupBy(family, "tree").agg(F.min(F.struct("node", *_AXES)).alias("r")).select(family, "tree", *[f"r.{c}" for c in _AXES]))
    groups = stored(placed.select(family, "tree").distinct().withColumn("root", F.col("tree")))
    box = placed.groupBy(family).agg(*[(F.max(c) - F.min(c)).alias(c) for c in _AXES])
    widest = box.agg(F.max(F.sqrt(sum((F.col(c) * F.col(c) for c in _AXES), F.lit(0.0))))).first()[0]
    links = []
    reach = first_reach(roots, placed, family, reach)
    while widest is not None:
        # Roots of families in which there is still another group.
        open_ = groups.groupBy(family).agg(F.countDistinct("root").alias("n")).where("n > 1").select(family)
        left = cut(roots.join(groups.where("tree = root").select(family, "tree"), [family, "tree"]).join(open_, family))
        if left.isEmpty():
            break
        edges = stored(near_nodes(left, placed.join(open_, family).join(groups, [family, "tree"]), family, reach))
        while True:
            taken = _round(edges, groups, family)
            if taken.isEmpty():
                break
            links.append(taken)
            key = lambda c: F.struct(family, F.col(c).alias("tree"))
            tops = groups.where("tree = root").join(taken.select(family, F.col("child").alias("tree"), "above"), [family, "tree"], "left")
            moved = depths(tops.select(key("tree").alias("node"), F.when(F.col("above").isNotNull(), key("above")).alias("parent")))
            moved = moved.select(F.col(f"node.{family}").alias(family), F.col("node.tree").alias("root"), F.col("root.tree").alias("top"))
            groups = stored(groups.join(moved, [family, "root"]).select(family, "tree", F.col("top").alias("root")))
        if reach > widest:
            break
        reach *= 2
    none = placed.select(family, F.col("tree").alias("child"), F.col("tree").alias("host"), "node", F.lit(0.0).alias("d")).where("false")
    return reduce(DataFrame.unionByName, [t.drop("above") for t in links], none)


def stitched(nodes: DataFrame, links: DataFrame, family: str) -> DataFrame:
    """nodes with each joined root's parent set to the node that it hangs below, and `whole`: the tree at the top of its group."""
    roots = nodes.where("parent is null").groupBy(family, F.col("tree").alias("child")).agg(F.min("node").alias("first"))
    hung = links.join(roots, [family, "child"]).select(family, F.col("child").alias("tree"), F.col("first").alias("node"), F.col("node").alias("_below"))
    key = lambda c: F.struct(family, F.col(c).alias("tree"))
    trees = nodes.select(family, "tree").distinct().join(links.select(family, F.col("child").alias("tree"), "host"), [family, "tree"], "left")
    tops = depths(trees.select(key("tree").alias("node"), F.when(F.col("host").isNotNull(), key("host")).alias("parent")))
    tops = tops.select(F.col(f"node.{family}").alias(family), F.col("node.tree").alias("tree"), F.col("root.tree").alias("whole"))
    out = nodes.join(hung, [family, "tree", "node"], "left").join(tops, [family, "tree"], "left")
    return out.withColumns({"parent": F.coalesce("parent", "_below"), "whole": F.coalesce("whole", "tree")}).drop("_below")
