"""Queries on skeletons: each label's vectors are a tree's nodes, three of their numbers the place of a node."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tracelake.functions.shared import shared_folder
from tracelake.operators import skeletons as ops
from tracelake.plans.registry import Registry
from tracelake.plans.signal_queries import r6
from tracelake.sources import skeletons

REGISTRY = Registry()
query = REGISTRY.query
#: Nodes in a smoothed one, sizes of a voxel, and the grid on which nodes may share a place.
SPAN, SIZES, GRID = 5, {"x": 0.75, "y": 0.75, "z": 2.0}, 4


def _nodes(spark, sf_dir, grid: bool = False):
    """A node's parent is the one of half its rank in the tree."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("label").cast("string").alias("tree"), F.col("vec_id").cast("long").alias("id"), F.lit(3).alias("kind"), F.lit(1.0).alias("radius"), *[F.get("embedding", F.lit(i)).cast("double").alias(a) for i, a in enumerate("xyz")])
    if grid:
        rows = rows.withColumns({a: F.floor(F.col(a) * GRID) for a in "xyz"})
    rows = rows.withColumn("node", F.expr("row_number() OVER (PARTITION BY tree ORDER BY id)").cast("long"))
    return rows.withColumn("parent", F.when(F.col("node") > 1, F.floor(F.col("node") / 2)))


def _read(spark, nodes):
    """The nodes, written as text and read again."""
    path = f"{shared_folder(spark)}/skeletons-{uuid.uuid4().hex}"
    skeletons.write_skeletons(nodes, path)
    return skeletons.skeletons(spark, path)


_TREE = "n AS MATERIALIZED (SELECT label::VARCHAR AS tree, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS node, count(*) OVER (PARTITION BY label) AS n, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)"
_REACH = f"least({(SPAN - 1) // 2}, node - 1, n - node)"


@query(f"""WITH {_TREE}, s AS (SELECT tree, node, {', '.join(f'avg({a}) OVER w AS {a}' for a in 'xyz')} FROM n WINDOW w AS (PARTITION BY tree ORDER BY node ROWS BETWEEN {_REACH} PRECEDING AND {_REACH} FOLLOWING))
SELECT tree, node, CASE WHEN node > 1 THEN node // 2 END AS parent, {', '.join(f'round({a} / {SIZES[a]}::DOUBLE, 6) AS {a}' for a in 'xyz')} FROM s""")
def skeleton_pixels(spark, sf_dir):
    """Nodes read from text, smoothed along the tree, in pixels."""
    made = ops.coordinates(ops.in_pixels(ops.smoothed(_read(spark, _nodes(spark, sf_dir)), SPAN), SIZES, "smooth"), "pixel")
    return made.select("tree", "node", "parent", *[r6(a).alias(a) for a in "xyz"])


@query(f"""WITH RECURSIVE {_TREE}, g AS MATERIALIZED (SELECT tree, node, CASE WHEN node > 1 THEN node // 2 END AS parent, floor(x * {GRID}) AS x, floor(y * {GRID}) AS y, floor(z * {GRID}) AS z FROM n),
d AS MATERIALIZED (SELECT g.tree, g.node, g.parent FROM g JOIN g p ON p.tree = g.tree AND p.node = g.parent WHERE p.x = g.x AND p.y = g.y AND p.z = g.z),
u AS (SELECT tree, node, parent AS up FROM g WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.tree = g.tree AND d.node = g.node) UNION ALL SELECT u.tree, u.node, d.parent FROM u JOIN d ON d.tree = u.tree AND d.node = u.up)
SELECT u.tree, u.node, up AS parent FROM u WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.tree = u.tree AND d.node = u.up)""")
def skeleton_repaired(spark, sf_dir):
    """Trees without segments of length zero, nodes being set on a grid."""
    return ops.without_zero_lengths(_read(spark, _nodes(spark, sf_dir, grid=True))).select("tree", "node", "parent")
