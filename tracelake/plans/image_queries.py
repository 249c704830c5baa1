"""Queries on images, volumes, masks and footprints, and on points and trees in space: each vector is an image of 8 by 8 pixels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.operators import graphs, space
from tracelake.operators import images as I
from tracelake.plans.frame_queries import _long
from tracelake.plans.registry import Registry
from tracelake.plans.signal_queries import r6
from tracelake.plans.table_queries import _LONG, _read

REGISTRY = Registry()
query = REGISTRY.query

_PIXELS = f"{_LONG}, g AS (SELECT vec_id, i, (i - 1) // 8 AS y, (i - 1) % 8 AS x, v FROM e)"
_POINTS = "p AS (SELECT vec_id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)"
AXES = ["x", "y", "z"]


def _pixels(spark, sf_dir):
    at = F.col("i") - 1
    return _long(spark, sf_dir).select("vec_id", "i", F.floor(at / 8).alias("y"), F.pmod(at, F.lit(8)).alias("x"), "v")


def _points(spark, sf_dir):
    return _read(spark, sf_dir, "embeddings").select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(a) for i, a in enumerate(AXES)])


@query(f"""WITH {_PIXELS}, r AS (SELECT vec_id, y FROM g GROUP BY 1, 2 HAVING NOT bool_and(v < 0.15)), c AS (SELECT vec_id, x FROM g GROUP BY 1, 2 HAVING NOT bool_and(v < 0.15))
SELECT vec_id, count(*) AS n, round(sum(v), 6) AS total FROM g JOIN r USING (vec_id, y) JOIN c USING (vec_id, x) GROUP BY 1""")
def prune_masked(spark, sf_dir):
    return I.pruned(_pixels(spark, sf_dir), "vec_id", F.col("v") < 0.15).groupBy("vec_id").agg(F.count("*").alias("n"), r6(F.sum("v")).alias("total"))


@query(f"""WITH RECURSIVE {_PIXELS}, b AS (SELECT vec_id, i, y, x FROM g WHERE v > 0.1),
reach AS (SELECT vec_id, i, i AS first, y, x FROM b UNION SELECT b.vec_id, b.i, r.first, b.y, b.x FROM reach r JOIN b ON b.vec_id = r.vec_id AND abs(b.y - r.y) <= 1 AND abs(b.x - r.x) <= 1),
f AS (SELECT vec_id, i, y, x, min(first) AS first FROM reach GROUP BY 1, 2, 3, 4), s AS (SELECT *, count(*) OVER (PARTITION BY vec_id, first) AS n FROM f)
SELECT vec_id, y, x, dense_rank() OVER (PARTITION BY vec_id ORDER BY first) AS component, n FROM s WHERE n >= 2""")
def components(spark, sf_dir):
    return I.components(_pixels(spark, sf_dir).where("v > 0.1"), "vec_id", least=2).select("vec_id", "y", "x", "component", "n")


@query("SELECT l_suppkey, l_linenumber::BIGINT AS y, l_quantity::BIGINT AS x, max(l_partkey) AS label FROM lineitem GROUP BY 1, 2, 3")
def label_image(spark, sf_dir):
    rows = _read(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_linenumber").cast("long").alias("y"), F.col("l_quantity").cast("long").alias("x"), F.col("l_partkey").alias("label"))
    return I.as_label_image(rows, "l_suppkey", "label")


@query(f"""WITH {_PIXELS}, d AS (SELECT unnest([-1, 0, 1]) AS d), o AS (SELECT DISTINCT vec_id, y + a.d AS y, x + b.d AS x FROM g, d a, d b WHERE v > 0.2)
SELECT vec_id, count(*) AS n FROM o WHERE y BETWEEN 0 AND 7 AND x BETWEEN 0 AND 7 GROUP BY 1""")
def dilated_masks(spark, sf_dir):
    return I.dilated(_pixels(spark, sf_dir).where("v > 0.2"), "vec_id", 8, 8).groupBy("vec_id").agg(F.count("*").alias("n"))


@query(f"""WITH {_LONG}, c AS (SELECT vec_id, i, v, p, count(*) OVER (PARTITION BY vec_id, i) AS n FROM e, range(5) AS t(p) WHERE i - 1 >= p * 12 AND i - 1 < p * 12 + 20)
SELECT vec_id, p AS patch, count(*) AS n, round(sum(v / n), 6) AS total FROM c GROUP BY 1, 2""")
def patch_seams(spark, sf_dir):
    rows = _long(spark, sf_dir).withColumn("place", F.col("i") - 1)
    parts = I.seam_weighted(rows, ["vec_id"], "place", step=12, size=20, patches=5, value="v")
    return parts.groupBy("vec_id", "patch").agg(F.count("*").alias("n"), r6(F.sum("part")).alias("total"))


@query(f"""WITH {_PIXELS} SELECT a.vec_id, a.i, round(sum(b.v * exp(-((a.y - b.y) ** 2 + (a.x - b.x) ** 2) / 2.0) / (1 + 2 * exp(-0.5)) ** 2), 6) AS v
FROM g a JOIN g b ON a.vec_id = b.vec_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY 1, 2""")
def blur_2d(spark, sf_dir):
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    made = rows.select("vec_id", F.posexplode(I.blurred_2d(F.col("x"), 8, 8, 1.0, 3)).alias("p", "e"))
    return made.select("vec_id", (F.col("p") + 1).cast("long").alias("i"), r6("e").alias("v"))


@query(f"""WITH {_LONG}, g AS (SELECT vec_id AS t, i - 1 AS c, (i - 1) // 16 AS z, (i - 1) // 4 % 4 AS y, (i - 1) % 4 AS x, v FROM e),
n AS (SELECT a.c, b.c AS d, coalesce(corr(a.v, b.v), 0) AS r FROM g a JOIN g b ON a.t = b.t AND a.c <> b.c AND abs(a.z - b.z) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY 1, 2)
SELECT c AS cell, round(avg(r), 6) AS rho FROM n GROUP BY 1""")
def neighbour_corr_3d(spark, sf_dir):
    frames = _read(spark, sf_dir, "embeddings").select(F.col("embedding").cast("array<double>").alias("x"))
    return I.neighbour_correlation(frames, "x", (4, 4, 4)).select(F.col("cell").cast("long").alias("cell"), r6("rho").alias("rho"))


@query(f"""WITH {_PIXELS}, w AS (SELECT vec_id, y, x, greatest(v, 0) AS w FROM g), k AS (SELECT vec_id, sqrt(sum(w * w)) AS e, max(w) AS m FROM w GROUP BY 1)
SELECT y, x, round(sum(w / nullif(e, 0)), 6) AS by_energy, round(sum(w / nullif(m, 0)), 6) AS by_max, count(*) FILTER (w > 0) AS n FROM w JOIN k USING (vec_id) GROUP BY 1, 2""")
def footprint_coverage(spark, sf_dir):
    rows = _pixels(spark, sf_dir).withColumn("w", F.greatest("v", F.lit(0.0)))
    return I.coverage(rows, "vec_id", ["y", "x"], "w").select("y", "x", r6("by_energy").alias("by_energy"), r6("by_max").alias("by_max"), "n")


@query(f"WITH {_PIXELS} SELECT vec_id, min(y) AS first, max(y) AS last FROM g WHERE v > 0.2 GROUP BY 1")
def segment_bounds(spark, sf_dir):
    return I.bounds(_pixels(spark, sf_dir).where("v > 0.2"), ["vec_id"], "y")


@query(f"""WITH {_PIXELS} SELECT vec_id, count(*) AS n, round(sum(greatest(v, 0)), 6) AS total FROM g WHERE y = vec_id % 8 GROUP BY 1 HAVING sum(greatest(v, 0)) <> 0""")
def own_plane(spark, sf_dir):
    rows = _pixels(spark, sf_dir).withColumn("w", F.greatest("v", F.lit(0.0)))
    planes = _read(spark, sf_dir, "embeddings").select("vec_id", F.pmod("vec_id", F.lit(8)).alias("plane"))
    return I.own_plane(rows, planes, "vec_id", "y", "w").groupBy("vec_id").agg(F.count("*").alias("n"), r6(F.sum("w")).alias("total"))


@query(f"""WITH {_PIXELS}, l AS (SELECT *, CASE WHEN v > 0.1 THEN 1 WHEN v < -0.1 THEN 2 ELSE 0 END AS k, abs(v) AS w FROM g)
SELECT vec_id, k::BIGINT AS part, round(sum(y * w) / sum(w), 6) AS cy, round(sum(x * w) / sum(w), 6) AS cx, count(*) AS n FROM l WHERE k <> 0 GROUP BY 1, 2""")
def mask_centroids(spark, sf_dir):
    rows = _pixels(spark, sf_dir).withColumn("part", F.when(F.col("v") > 0.1, 1).when(F.col("v") < -0.1, 2).otherwise(0).cast("long"))
    return I.centroids(rows, "vec_id", "part", F.abs("v")).select("vec_id", "part", r6("cy").alias("cy"), r6("cx").alias("cx"), "n")


@query(f"""WITH {_POINTS}, m AS (SELECT label, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM p GROUP BY 1)
SELECT vec_id, round(x - mx, 6) AS j_x, round(y - my, 6) AS j_y, round(z - mz, 6) AS j_z, round(sqrt((x - mx) ** 2 + (y - my) ** 2 + (z - mz) ** 2), 6) AS distance FROM p JOIN m USING (label)""")
def centroid_jitter(spark, sf_dir):
    return space.jitter(_points(spark, sf_dir), "label", AXES).select("vec_id", *[r6(f"j_{a}").alias(f"j_{a}") for a in AXES], r6("distance").alias("distance"))


@query(f"""WITH {_POINTS}, u AS (SELECT label, x / nullif(sqrt(x * x + y * y + z * z), 0) AS x, y / nullif(sqrt(x * x + y * y + z * z), 0) AS y, z / nullif(sqrt(x * x + y * y + z * z), 0) AS z FROM p),
s AS (SELECT label, sum(x) AS x, sum(y) AS y, sum(z) AS z FROM u GROUP BY 1)
SELECT label, round(x / nullif(sqrt(x * x + y * y + z * z), 0), 6) AS x, round(y / nullif(sqrt(x * x + y * y + z * z), 0), 6) AS y, round(z / nullif(sqrt(x * x + y * y + z * z), 0), 6) AS z FROM s""")
def mean_normals(spark, sf_dir):
    return space.mean_direction(_points(spark, sf_dir), ["label"], AXES).select("label", *[r6(a).alias(a) for a in AXES])


@query(f"""WITH {_POINTS}, s AS (SELECT label, vec_id, x, y, z, lead(x) OVER w AS x2, lead(y) OVER w AS y2, lead(z) OVER w AS z2 FROM p WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
t AS (SELECT *, (x + y) / ((x + y) - (x2 + y2)) AS t FROM s WHERE (x + y) * (x2 + y2) <= 0 AND x + y <> x2 + y2),
h AS (SELECT label, vec_id, x + t * (x2 - x) AS px, sqrt((x + t * (x2 - x)) ** 2 + (y + t * (y2 - y)) ** 2 + (z + t * (z2 - z)) ** 2) AS d FROM t)
SELECT label, vec_id AS node, round(px, 6) AS at_x, round(d, 6) AS d FROM h WHERE d <= 0.5 QUALIFY row_number() OVER (PARTITION BY label ORDER BY d, vec_id) = 1""")
def segment_plane(spark, sf_dir):
    hits = space.plane_hits(_points(spark, sf_dir), "label", "vec_id", AXES, [0.0, 0.0, 0.0], [1.0, 1.0, 0.0], 0.5)
    return hits.select("label", "node", r6(F.get("at", F.lit(0))).alias("at_x"), r6("d").alias("d"))


@query("""WITH RECURSIVE t AS (SELECT vec_id AS node, vec_id AS root, 0 AS depth, vec_id::VARCHAR AS path FROM embeddings WHERE vec_id <= 1
UNION ALL SELECT e.vec_id, t.root, t.depth + 1, t.path || '/' || e.vec_id FROM t JOIN embeddings e ON e.vec_id > 1 AND e.vec_id // 2 = t.node)
SELECT root, depth::BIGINT AS depth, path FROM t QUALIFY row_number() OVER (PARTITION BY root ORDER BY depth DESC, node) = 1""")
def longest_path(spark, sf_dir):
    nodes = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("node"), F.when(F.col("vec_id") > 1, F.floor(F.col("vec_id") / 2)).alias("parent"))
    return graphs.longest_paths(nodes).select("root", F.col("depth").cast("long").alias("depth"), F.array_join("path", "/").alias("path"))
