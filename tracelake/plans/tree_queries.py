"""Queries on trees in space that are joined into one."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.operators import stitching
from tracelake.plans.registry import Registry
from tracelake.plans.signal_queries import r6

REGISTRY = Registry()
query = REGISTRY.query
#: Nodes a tree, by ids that follow each other; each label's trees are a family.
IDS = 60
#: How far the first search for near nodes goes.
REACH = 0.2


def _trees(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("label", F.floor(F.col("vec_id") / IDS).alias("tree"), F.col("vec_id").cast("long").alias("node"), F.col("embedding").cast("array<double>").alias("e"))
    first = rows.groupBy("label", "tree").agg(F.min("node").alias("first"))
    parent = F.when(F.col("node") > F.col("first"), F.col("first"))
    return rows.join(first, ["label", "tree"]).select("label", "tree", "node", parent.alias("parent"), *[F.get("e", F.lit(i)).alias(c) for i, c in enumerate("xyz")])


_PAIRS = f"""n AS (SELECT label, vec_id // {IDS} AS tree, vec_id AS node, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
r AS (SELECT label, tree, arg_min(x, node) AS x, arg_min(y, node) AS y, arg_min(z, node) AS z FROM n GROUP BY 1, 2),
d AS (SELECT label, r.tree AS child, n.tree AS host, node, sqrt((n.x - r.x) * (n.x - r.x) + (n.y - r.y) * (n.y - r.y) + (n.z - r.z) * (n.z - r.z)) AS d FROM r JOIN n USING (label) WHERE r.tree <> n.tree),
e AS (SELECT label, child, host, min(d) AS d, arg_min(node, (d, node)) AS node FROM d GROUP BY 1, 2, 3),
o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY d, child, host) AS i FROM e)"""
_LINKS = f"""{_PAIRS}, s(label, i, tops, taken) AS (
SELECT label, 0::BIGINT, map_from_entries(list((tree, tree))), []::BIGINT[] FROM r GROUP BY label
UNION ALL SELECT s.label, s.i + 1,
CASE WHEN tops[child] = child AND tops[host] <> child THEN map_from_entries(list_transform(map_entries(tops), lambda t: (t.key, CASE WHEN t.value = child THEN tops[host] ELSE t.value END))) ELSE tops END,
CASE WHEN tops[child] = child AND tops[host] <> child THEN list_append(taken, s.i + 1) ELSE taken END
FROM s JOIN o ON o.label = s.label AND o.i = s.i + 1),
l AS (SELECT label, unnest(arg_max(taken, i)) AS i FROM s GROUP BY 1)"""


@query(f"WITH RECURSIVE {_LINKS} SELECT label, child, host, node, round(d, 6) AS d FROM l JOIN o USING (label, i)")
def tree_stitches(spark, sf_dir):
    """The links that join each label's trees into one, nearest first."""
    links = stitching.stitches(_trees(spark, sf_dir), "label", REACH)
    return links.select("label", "child", "host", "node", r6("d").alias("d"))


@query(f"""WITH RECURSIVE {_LINKS}, t AS (SELECT label, arg_max(tops, i) AS tops FROM s GROUP BY 1), f AS (SELECT label, tree, min(node) AS first FROM n GROUP BY 1, 2)
SELECT label, tree, n.node AS node, CASE WHEN n.node > first THEN first ELSE h.node END AS parent, tops[tree] AS whole
FROM n JOIN f USING (label, tree) JOIN t USING (label) LEFT JOIN (SELECT label, child AS tree, node FROM l JOIN o USING (label, i)) h USING (label, tree)""")
def stitched_trees(spark, sf_dir):
    """Every node with its parent in the one tree that its label's trees become."""
    nodes = _trees(spark, sf_dir)
    return stitching.stitched(nodes, stitching.stitches(nodes, "label", REACH), "label").select("label", "tree", "node", "parent", "whole")
