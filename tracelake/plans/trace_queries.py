"""Queries on vectors as frames of 64 pixels: each label is a recording of seven overlapping components on a background."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.operators import traces
from tracelake.plans.registry import Registry
from tracelake.plans.signal_queries import r6

REGISTRY = Registry()
query = REGISTRY.query
#: Components, the pixels from one to the next, and the pixels of each.
COMPONENTS, STEP, WIDTH = 7, 8, 12
#: Share of a component's energy within its support; percentile and half width of the trend.
SHARE, P, HALF = 0.9, 0.2, 25


def _tables(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("label", F.col("vec_id").alias("t"), F.posexplode("embedding").alias("pixel", "v"))
    movie = rows.select("label", F.col("pixel").cast("long").alias("pixel"), "t", (F.col("v").cast("double") + 1).alias("v"))
    comp = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(COMPONENTS - 1).cast("long")))
    inside = movie.withColumn("comp", comp).where((F.col("pixel") >= STEP * F.col("comp")) & (F.col("pixel") < STEP * F.col("comp") + WIDTH))
    spatial = inside.groupBy("label", "comp", "pixel").agg(F.avg(F.abs(F.col("v") - 1)).alias("w"))
    temporal = inside.groupBy("label", "comp", "t").agg((F.max("v") - 1).alias("v"))
    back = movie.withColumn("comp", F.lit(0).cast("long"))
    return movie, spatial, temporal, back.groupBy("label", "comp", "pixel").agg(F.avg("v").alias("w")), back.groupBy("label", "comp", "t").agg(F.avg("v").alias("v"))


_PARTS = f"""m AS MATERIALIZED (SELECT label, i - 1 AS pixel, vec_id AS t, v + 1 AS v FROM (SELECT label, vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(1, 65)) AS i FROM embeddings)),
k AS (SELECT m.*, comp FROM m, (SELECT unnest(range(0, {COMPONENTS})) AS comp) WHERE pixel >= {STEP} * comp AND pixel < {STEP} * comp + {WIDTH}),
a0 AS (SELECT label, comp, pixel, avg(abs(v - 1)) AS w FROM k GROUP BY ALL), b0 AS (SELECT label, pixel, avg(v) AS w FROM m GROUP BY ALL),
an AS (SELECT label, comp, sqrt(sum(w * w)) AS norm FROM a0 GROUP BY ALL), bn AS (SELECT label, sqrt(sum(w * w)) AS norm FROM b0 GROUP BY ALL),
s AS (SELECT label, comp, pixel, w / norm AS w, coalesce(sum(w * w / norm / norm) OVER (PARTITION BY label, comp ORDER BY w DESC, pixel ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < {SHARE} * sum(w * w / norm / norm) OVER (PARTITION BY label, comp) AS held FROM a0 JOIN an USING (label, comp)),
a AS MATERIALIZED (SELECT label, comp, pixel, w, CASE WHEN held THEN 1 / sqrt(count(*) FILTER (held) OVER (PARTITION BY label, comp)) ELSE 0 END AS u FROM s),
b AS MATERIALIZED (SELECT label, pixel, w / norm AS w FROM b0 JOIN bn USING (label)),
c AS MATERIALIZED (SELECT label, comp, t, (max(v) - 1) * any_value(norm) AS c FROM k JOIN an USING (label, comp) GROUP BY ALL),
f AS MATERIALIZED (SELECT label, t, avg(v) * any_value(norm) AS f FROM m JOIN bn USING (label) GROUP BY ALL),
ay AS (SELECT label, comp, t, sum(w * v) AS seen, sum(u * v) AS raw_seen FROM m JOIN a USING (label, pixel) GROUP BY ALL),
g AS (SELECT x.label, x.comp, y.comp AS other, sum(x.w * y.w) AS g FROM a x JOIN a y ON x.label = y.label AND x.pixel = y.pixel GROUP BY ALL),
ow AS (SELECT g.label, g.comp, c.t, sum(g * c) AS own FROM g JOIN c ON c.label = g.label AND c.comp = g.other GROUP BY ALL),
h AS (SELECT a.label, comp, sum(a.w * b.w) AS g, sum(u * b.w) AS h FROM a JOIN b USING (label, pixel) GROUP BY ALL),
p AS MATERIALIZED (SELECT label, comp, t, c, seen - own AS yf, seen - own - g * f + c AS yr, raw_seen - h * f AS raw, h * f AS raw_back
FROM ay JOIN ow USING (label, comp, t) JOIN c USING (label, comp, t) JOIN h USING (label, comp) JOIN f USING (label, t))"""


def _trend(signal: str) -> str:
    return f"quantile_cont({signal}, {P}) OVER (PARTITION BY label, comp ORDER BY t ROWS BETWEEN {HALF} PRECEDING AND {HALF} FOLLOWING)"


@query(f"WITH {_PARTS} SELECT label, comp, t, {', '.join(f'round({c}, 6) AS {c}' for c in ('c', 'yf', 'yr', 'raw', 'raw_back'))} FROM p")
def unmixed_traces(spark, sf_dir):
    """What the frames hold of each component, less the others and the background."""
    made = traces.unmixed(*_tables(spark, sf_dir), ["label"], SHARE)
    return made.select("label", "comp", "t", *[r6(c).alias(c) for c in ("c", "yf", "yr", "raw", "raw_back")])


_KINDS = ("inferred", "filtered", "raw")


@query(f"""WITH {_PARTS}, q AS (SELECT *, {_trend('c')} AS inferred_trend, {_trend('yr')} AS filtered_trend, {_trend('raw')} AS raw_trend FROM p),
z AS (SELECT *, yf + inferred_trend AS inferred_f, yf - yr + c + filtered_trend AS filtered_f, raw_back + raw_trend AS raw_f, c - inferred_trend AS inferred_df, yr - filtered_trend AS filtered_df, raw - raw_trend AS raw_df FROM q)
SELECT label, comp, t, {', '.join(f'round({k}_df, 6) AS {k}_df, round({k}_f, 6) AS {k}_f, round(CASE WHEN abs({k}_f) > 0.01 THEN {k}_df / {k}_f END, 6) AS {k}_dfof' for k in _KINDS)} FROM z""")
def extracted_traces(spark, sf_dir):
    """Inferred, filtered and raw traces above their trends, and over their levels where those aren't near zero."""
    made = traces.extracted(traces.unmixed(*_tables(spark, sf_dir), ["label"], SHARE), ["label"], P, HALF)
    columns = [c for k in _KINDS for c in (r6(f"{k}_df").alias(f"{k}_df"), r6(f"{k}_f").alias(f"{k}_f"), F.when(F.abs(f"{k}_f") > 0.01, r6(f"{k}_dfof")).alias(f"{k}_dfof"))]
    return made.select("label", "comp", "t", *columns)
