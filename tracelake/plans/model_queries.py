"""Queries on geometry, trees, models and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.operators import graphs, models, space
from tracelake.plans.signal_queries import r6
from tracelake.plans.table_queries import _LONG
from tracelake.streaming import blocks, windows

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _vectors(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


@query("""WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings),
n AS (SELECT a.vec_id, count(*) AS n_near, min(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS least FROM p a JOIN p b ON a.vec_id <> b.vec_id AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 0.02 GROUP BY 1)
SELECT vec_id, coalesce(n_near, 0) AS n_near, round(least, 6) AS least FROM p LEFT JOIN n USING (vec_id)""")
def range_nn(spark, sf_dir):
    points = _vectors(spark, sf_dir).select("vec_id", F.get("x", F.lit(0)).alias("x"), F.get("x", F.lit(1)).alias("y"))
    return space.near_points(points, points, 0.02, "vec_id").select("vec_id", "n_near", r6("least").alias("least"))


@query(f"""WITH {_LONG}, s AS (SELECT vec_id, i, v, lead(v) OVER (PARTITION BY vec_id ORDER BY i) AS w FROM e)
SELECT vec_id, count(*) AS n_crossings, round(min(i + v / (v - w)), 6) AS first_at FROM s WHERE v * w < 0 GROUP BY 1""")
def plane_cross(spark, sf_dir):
    found = _vectors(spark, sf_dir).select("vec_id", space.crossings(F.col("x"), 0.0).alias("at")).where(F.size("at") > 0)
    return found.select("vec_id", F.size("at").cast("long").alias("n_crossings"), r6(F.array_min("at")).alias("first_at"))


@query("""SELECT r_name AS name, 0::BIGINT AS depth, r_name AS path FROM region
UNION ALL SELECT n_name, 1, r_name || '/' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def path_to_root(spark, sf_dir):
    region, nation = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("region", "nation"))
    below = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat(F.lit("n:"), "n_name").alias("node"), F.concat(F.lit("r:"), "r_name").alias("parent"))
    nodes = region.select(F.concat(F.lit("r:"), "r_name").alias("node"), F.lit(None).cast("string").alias("parent")).unionByName(below)
    bare = lambda c: F.substring(c, 3, 1000)
    return graphs.root_paths(nodes).select(bare(F.col("node")).alias("name"), F.col("depth").cast("long").alias("depth"), F.array_join(F.transform("path", bare), "/").alias("path"))


@query(f"""WITH {_LONG}, t AS (SELECT i, avg(v) AS m FROM e GROUP BY 1), o AS (SELECT unnest(range(-5, 6)) AS shift),
c AS (SELECT vec_id, shift, corr(v, m) AS r FROM e, o JOIN t ON t.i = e.i + o.shift GROUP BY 1, 2)
SELECT vec_id, max_by(shift, r) AS shift, round(max(r), 6) AS r FROM c GROUP BY 1""")
def shift_search(spark, sf_dir):
    long = _vectors(spark, sf_dir).select("vec_id", F.posexplode("x").alias("i", "v"))
    template = long.groupBy("i").agg(F.avg("v").alias("m")).withColumnRenamed("i", "at")
    moved = long.select("vec_id", "i", "v", F.explode(F.sequence(F.lit(-5), F.lit(5))).alias("shift")).withColumn("at", F.col("i") + F.col("shift"))
    by_shift = moved.join(template, "at").groupBy("vec_id", "shift").agg(F.corr("v", "m").alias("r"))
    best = by_shift.groupBy("vec_id").agg(F.max_by("shift", "r").alias("shift"), F.max("r").alias("r"))
    return best.select("vec_id", F.col("shift").cast("long").alias("shift"), r6("r").alias("r"))


@query(None)
def ridge_cv(spark, sf_dir):
    return models.ridge_cv(_vectors(spark, sf_dir), "vec_id", "x")


@query(None)
def kmeans(spark, sf_dir):
    return models.clusters(_vectors(spark, sf_dir), "vec_id", "x", 5)


@query(None)
def gauss_fit(spark, sf_dir):
    return models.mixture(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), F.col("l_quantity"))


_GONE = "<= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR"


@query(f"""WITH f AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS bout FROM f),
b AS (SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n FROM g GROUP BY user_id, bout)
SELECT user_id, epoch_us(first_ts) AS first_us, epoch_us(last_ts) AS last_us, n FROM b WHERE last_ts + INTERVAL 6 HOUR {_GONE}""")
def bout_stream(spark, sf_dir):
    rows = windows.drained(windows.stream_bouts(windows.event_stream(spark, sf_dir), "user_id", "6 hours", "2 hours"))
    return rows.select("user_id", F.unix_micros("first_ts").alias("first_us"), F.unix_micros("last_ts").alias("last_us"), "n")


@query(f"""SELECT event_type, epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS start_us, count(*) AS n, round(avg(value), 6) AS mean_value FROM events
GROUP BY event_type, time_bucket(INTERVAL 1 DAY, ts) HAVING time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY {_GONE}""")
def rate_stream(spark, sf_dir):
    rows = windows.drained(windows.stream_rates(windows.event_stream(spark, sf_dir), "event_type", "value", "1 day", "2 hours"))
    return rows.select("event_type", F.unix_micros("window_start").alias("start_us"), "n", r6("mean_value").alias("mean_value"))


@query(f"""SELECT event_type, epoch_us(start) AS start_us, count(*) AS n, round(quantile_cont(value, 0.2), 6) AS low
FROM (SELECT event_type, value, time_bucket(INTERVAL 1 DAY, ts) - INTERVAL 1 DAY * unnest(range(0, 3)) AS start FROM events WHERE value IS NOT NULL)
GROUP BY event_type, start HAVING start + INTERVAL 3 DAY {_GONE}""")
def low_stream(spark, sf_dir):
    """The lower fifth of the values of three days, day by day."""
    rows = windows.drained(windows.stream_percentiles(windows.event_stream(spark, sf_dir), "event_type", "value", 0.2, "3 days", "1 day", "2 hours"))
    return rows.select("event_type", F.unix_micros("window_start").alias("start_us"), "n", r6("low").alias("low"))


@query("""WITH r AS (SELECT user_id, event_id, epoch_us(ts) AS us, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events WHERE user_id IS NOT NULL AND epoch_us(ts) <= (SELECT epoch_ms(max(ts)) * 1000 - 7200000000 FROM events)),
b AS (SELECT *, count(*) OVER (PARTITION BY user_id, i // 8) AS n FROM r)
SELECT user_id, i // 8 AS block, i % 8 AS place, us, event_id, value FROM b WHERE n = 8""")
def block_stream(spark, sf_dir):
    """Events of a user in blocks of eight; what doesn't fill one waits in the state."""
    rows = windows.drained(blocks.stream_blocks(windows.event_stream(spark, sf_dir), "user_id", ["event_id"], ["value"], 8, "2 hours"))
    return rows.select("user_id", "block", "place", F.unix_micros("ts").alias("us"), "event_id", "value")
