"""Queries on vectors as 8 by 8 frames: each label is a plane with its own clock."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.operators import resampling
from tracelake.plans.registry import Registry
from tracelake.plans.signal_queries import r6

REGISTRY = Registry()
query = REGISTRY.query
AXES = {"y": (1.0, 0.75), "x": (1.0, 1.6)}
#: Values from here on are missing; the common clock's step.
TOP, STEP = 0.3, 70


def _frames(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("label", "vec_id", F.posexplode("embedding").alias("i", "v"))
    v = F.col("v").cast("double")
    return rows.select("label", "vec_id", F.floor(F.col("i") / 8).alias("y"), (F.col("i") % 8).cast("long").alias("x"), F.when(v < TOP, v).alias("v"))


_SPACE = f"""p AS (SELECT label, vec_id, (i - 1) // 8 AS y, (i - 1) % 8 AS x, CASE WHEN v < {TOP} THEN v END AS v FROM (SELECT label, vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(1, 65)) AS i FROM embeddings)),
wy AS (SELECT i AS y, j AS ny, 1 - abs(j * 0.75::DOUBLE - i) AS w FROM (SELECT unnest(range(0, 8)) AS i), (SELECT unnest(range(0, 10)) AS j) WHERE abs(j * 0.75::DOUBLE - i) < 1),
wx AS (SELECT i AS x, j AS nx, 1 - abs(j * 1.6::DOUBLE - i) AS w FROM (SELECT unnest(range(0, 8)) AS i), (SELECT unnest(range(0, 5)) AS j) WHERE abs(j * 1.6::DOUBLE - i) < 1)"""


@query(f"""WITH {_SPACE} SELECT label, vec_id, ny AS y, nx AS x, round(CASE WHEN bool_and(v IS NOT NULL) THEN sum(v * wy.w * wx.w) END, 6) AS v FROM p JOIN wy USING (y) JOIN wx USING (x) GROUP BY 1, 2, 3, 4""")
def frames_in_space(spark, sf_dir):
    """Frames on a finer grid of rows and a coarser one of columns, missing where a value that counts is."""
    return resampling.in_space(_frames(spark, sf_dir), ["label", "vec_id"], AXES, "v").select("label", "vec_id", "y", "x", r6("v").alias("v"))


@query(f"""WITH b AS (SELECT DISTINCT label, i FROM (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(1, 65)) AS i FROM embeddings) WHERE v >= {TOP}),
p AS (SELECT e.label, vec_id, (e.i - 1) // 8 AS y, (e.i - 1) % 8 AS x, CASE WHEN b.i IS NULL THEN v END AS v FROM (SELECT label, vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(1, 65)) AS i FROM embeddings) e LEFT JOIN b ON b.label = e.label AND b.i = e.i),
s AS (SELECT label, min(10 * vec_id + 3 * label) AS zero FROM embeddings WHERE embedding[1] > 0.1 GROUP BY 1),
c AS (SELECT label, vec_id, t, lead(t) OVER w AS t2, lead(vec_id) OVER w AS next FROM (SELECT label, vec_id, 10 * vec_id + 3 * label - coalesce(zero, 0) AS t FROM embeddings LEFT JOIN s USING (label)) WINDOW w AS (PARTITION BY label ORDER BY t)),
g AS (SELECT label, vec_id, next, t, t2, unnest(range(ceil(t / {STEP})::BIGINT, CASE WHEN t2 IS NULL THEN floor(t / {STEP})::BIGINT + 1 ELSE ceil(t2 / {STEP})::BIGINT END)) * {STEP} AS g FROM c)
SELECT g.label, p.y, p.x, g AS t, round(CASE WHEN g = g.t THEN p.v ELSE p.v * (1 - (g - g.t) / (t2 - g.t)) + q.v * ((g - g.t) / (t2 - g.t)) END, 6) AS v
FROM g JOIN p ON p.label = g.label AND p.vec_id = g.vec_id LEFT JOIN p q ON q.label = g.label AND q.vec_id = next AND q.y = p.y AND q.x = p.x""")
def planes_in_time(spark, sf_dir):
    """Every plane on one clock that begins at its first stimulus (a first value above 0.1); a pixel that is ever missing is so throughout."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("label", "vec_id", (10 * F.col("vec_id") + 3 * F.col("label")).cast("long").alias("t"), F.get("embedding", F.lit(0)).alias("first"))
    clocks = resampling.aligned(rows.select("label", "vec_id", "t"), rows.where("first > 0.1").select("label", F.col("t").alias("onset")), "label")
    frames = resampling.missing_throughout(_frames(spark, sf_dir), ["label", "y", "x"], "v")
    made = resampling.in_time(frames, resampling.clock_weights(clocks, ["label"], "vec_id", STEP), ["label"], "vec_id", ["y", "x"], "v")
    return made.select("label", "y", "x", "t", r6("v").alias("v"))
