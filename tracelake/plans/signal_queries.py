"""Queries on the events: detection, alignment, trials and responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.operators import events as E
from tracelake.operators import series as S
from tracelake.operators.columns import midpoint_percentile, ratio, ticks

DAY = 86_400_000_000
QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None):
    """Register a query by its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "value", ticks().alias("t"))


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


_EV = "ev AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS t FROM events)"
_PAIRS = f"""{_EV}, pairs AS (SELECT s.user_id, s.value, o.event_id AS trial, s.t - o.t AS rel FROM ev s JOIN ev o ON s.user_id = o.user_id
  AND o.event_type = 'signup' AND s.event_type <> 'signup' AND s.t - o.t >= -3 * 86400000000 AND s.t - o.t < 3 * 86400000000)"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    onsets = ev.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("trial"), F.col("t").alias("onset"))
    return E.within(ev.where("event_type <> 'signup'"), onsets, "user_id", 3 * DAY, 3 * DAY)


def _per_trial(pairs: DataFrame) -> DataFrame:
    before, after = F.when(F.col("rel") < 0, F.col("value")), F.when(F.col("rel") >= 0, F.col("value"))
    return pairs.groupBy("user_id", "trial").agg(F.avg(before).alias("base"), F.stddev_samp(before).alias("sd"), F.avg(after).alias("resp"))


_TRIALS = f"""{_PAIRS}, tr AS (SELECT user_id, trial, avg(value) FILTER (rel < 0) AS base, stddev_samp(value) FILTER (rel < 0) AS sd, avg(value) FILTER (rel >= 0) AS resp FROM pairs GROUP BY 1, 2)"""


@query(f"""WITH {_TRIALS}, n AS (SELECT user_id, (resp - base) / nullif(base, 0) AS dff, (resp - base) / nullif(sd, 0) AS snr FROM tr)
SELECT user_id, round(avg(dff), 6) AS mean_dff, round(median(dff), 6) AS median_dff, round(stddev_samp(dff) / sqrt(count(dff)), 6) AS sem_dff, round(avg(snr), 6) AS mean_snr, count(*) AS trials FROM n GROUP BY 1""")
def trial_response(spark, sf_dir):
    tr = _per_trial(_pairs(spark, sf_dir))
    dff, snr = ratio(F.col("resp") - F.col("base"), F.col("base")), ratio(F.col("resp") - F.col("base"), F.col("sd"))
    rows = tr.select("user_id", dff.alias("dff"), snr.alias("snr"))
    return rows.groupBy("user_id").agg(r6(F.avg("dff")).alias("mean_dff"), r6(F.percentile("dff", F.lit(0.5))).alias("median_dff"), r6(ratio(F.stddev_samp("dff"), F.sqrt(F.count("dff")))).alias("sem_dff"), r6(F.avg("snr")).alias("mean_snr"), F.count("*").alias("trials"))


@query(f"WITH {_TRIALS} SELECT user_id, trial, round((resp - base) / nullif(abs(base), 0), 6) AS dff FROM tr")
def dff_baseline(spark, sf_dir):
    return _per_trial(_pairs(spark, sf_dir)).select("user_id", "trial", r6(ratio(F.col("resp") - F.col("base"), F.abs("base"))).alias("dff"))


@query(f"WITH {_TRIALS} SELECT user_id, trial, round((resp - base) / nullif(sd, 0), 6) AS snr FROM tr")
def snr_baseline(spark, sf_dir):
    return _per_trial(_pairs(spark, sf_dir)).select("user_id", "trial", r6(ratio(F.col("resp") - F.col("base"), F.col("sd"))).alias("snr"))


@query(f"""WITH {_PAIRS}, b AS (SELECT user_id, trial, avg(value) FILTER (rel < 0) AS base, list(value ORDER BY value) FILTER (rel >= 0) AS v FROM pairs GROUP BY 1, 2),
q AS (SELECT *, len(v) AS n, greatest(1.0, least(len(v)::DOUBLE, len(v) * 0.8 + 0.5)) AS hi, greatest(1.0, least(len(v)::DOUBLE, len(v) * 0.2 + 0.5)) AS lo FROM b)
SELECT user_id, trial, round(v[floor(hi)::INT] + (v[least(floor(hi)::INT + 1, n)] - v[floor(hi)::INT]) * (hi - floor(hi)) - base, 6) AS p80,
round(v[floor(lo)::INT] + (v[least(floor(lo)::INT + 1, n)] - v[floor(lo)::INT]) * (lo - floor(lo)) - base, 6) AS p20 FROM q""")
def pctl_response(spark, sf_dir):
    rows = _pairs(spark, sf_dir).groupBy("user_id", "trial").agg(F.avg(F.when(F.col("rel") < 0, F.col("value"))).alias("base"), F.collect_list(F.when(F.col("rel") >= 0, F.col("value"))).alias("v"))
    return rows.select("user_id", "trial", *[r6(midpoint_percentile(F.col("v"), p) - F.col("base")).alias(f"p{p}") for p in (80, 20)])


@query(f"""WITH {_PAIRS} SELECT floor(rel / 21600000000)::BIGINT AS rel_bin, round(avg(value), 6) AS mean_value, round(median(value), 6) AS median_value, round(stddev_samp(value) / sqrt(count(*)), 6) AS sem_value, count(*) AS n FROM pairs GROUP BY 1""")
def trial_psth(spark, sf_dir):
    rows = _pairs(spark, sf_dir).withColumn("rel_bin", F.floor(F.col("rel") / (DAY // 4)).cast("long"))
    return rows.groupBy("rel_bin").agg(r6(F.avg("value")).alias("mean_value"), r6(F.percentile("value", F.lit(0.5))).alias("median_value"), r6(ratio(F.stddev_samp("value"), F.sqrt(F.count("*")))).alias("sem_value"), F.count("*").alias("n"))


@query(f"""WITH {_EV}, g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) < 86400000000 THEN 0 ELSE 1 END AS new FROM ev),
b AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t) AS bout FROM g) SELECT user_id, min(t) AS "first", max(t) AS "last", count(*) AS n FROM b GROUP BY user_id, bout""")
def bout_merge(spark, sf_dir):
    return E.bouts(_events(spark, sf_dir), "user_id", "t", DAY)


@query(f"""WITH {_EV}, c AS (SELECT * FROM ev WHERE event_type = 'click'), g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) <= 2 * 86400000000 THEN 0 ELSE 1 END AS new FROM c),
b AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t) AS train FROM g) SELECT user_id, min(t) AS "first", max(t) AS "last", count(*) AS n FROM b GROUP BY user_id, train""")
def pulse_trains(spark, sf_dir):
    return E.bouts(_events(spark, sf_dir).where("event_type = 'click'"), "user_id", "t", 2 * DAY, least=True)


@query(f"""WITH {_EV}, i AS (SELECT user_id, value > 20 AS up, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS i FROM ev),
g AS (SELECT user_id, i, i - row_number() OVER (PARTITION BY user_id ORDER BY i) AS run FROM i WHERE up) SELECT user_id, min(i) AS onset, max(i) + 1 AS "offset", count(*) AS n FROM g GROUP BY user_id, run""")
def threshold_islands(spark, sf_dir):
    return E.islands(_events(spark, sf_dir), "user_id", ["t", "event_id"], F.col("value") > 20)


@query(f"""WITH {_EV}, l AS (SELECT * FROM ev WHERE event_type = 'click'), r AS (SELECT * FROM ev WHERE event_type = 'signup')
SELECT l.event_id, arg_min(r.t, (abs(r.t - l.t), r.t)) AS near_t, arg_min(r.event_id, (abs(r.t - l.t), r.t)) AS near_event_id FROM l LEFT JOIN r USING (user_id) GROUP BY 1""")
def nearest_frame(spark, sf_dir):
    ev = _events(spark, sf_dir)
    left = ev.where("event_type = 'click'").select("event_id", "user_id", "t")
    right = ev.where("event_type = 'signup'").select("user_id", "t", F.col("event_id").alias("frame"))
    return E.nearest(left, right, "user_id", "t", "frame").select("event_id", "near_t", F.col("near_frame").alias("near_event_id"))


_HOUR = 3_600_000_000
_HOURS = f"""{_EV}, e AS (SELECT floor(min(t) / 3600000000)::BIGINT AS a, floor(max(t) / 3600000000)::BIGINT + 4 AS b FROM ev), h AS (SELECT unnest(range(a, b + 1)) AS hour FROM e)"""


def _hours(ev: DataFrame) -> DataFrame:
    """The hours from the first event to four past the last, by number."""
    ends = ev.agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a is not null")
    return ends.select(F.explode(F.sequence(F.floor(F.col("a") / _HOUR).cast("long"), F.floor(F.col("b") / _HOUR).cast("long") + 4)).alias("hour"))


def _lit_hours(signups: DataFrame, *key: str) -> DataFrame:
    """The hours that start within the four hours from a signup's time on, each once by key."""
    first, end = (F.ceil((F.col("t") + h * _HOUR) / _HOUR).cast("long") for h in (0, 4))
    return signups.select(*key, F.explode(F.sequence(first, end - 1)).alias("hour")).distinct().withColumn("stim", F.lit(1))


@query(f"""WITH {_HOURS}, s AS (SELECT t FROM ev WHERE event_type = 'signup')
SELECT hour::BIGINT AS hour, CASE WHEN EXISTS (SELECT 1 FROM s WHERE h.hour * 3600000000 >= s.t AND h.hour * 3600000000 < s.t + 4 * 3600000000) THEN 1 ELSE 0 END AS stim FROM h""")
def stim_indicator(spark, sf_dir):
    ev = _events(spark, sf_dir)
    on = _lit_hours(ev.where("event_type = 'signup'"))
    return _hours(ev).join(on, "hour", "left").select("hour", F.coalesce("stim", F.lit(0)).alias("stim"))


@query(f"""WITH {_HOURS}, s AS (SELECT user_id, t FROM ev WHERE event_type = 'signup'), u AS (SELECT DISTINCT user_id FROM s)
SELECT u.user_id, h.hour, CASE WHEN EXISTS (SELECT 1 FROM s WHERE s.user_id IS NOT DISTINCT FROM u.user_id AND h.hour * 3600000000 >= s.t AND h.hour * 3600000000 < s.t + 4 * 3600000000) THEN 1 ELSE 0 END AS stim FROM u, h""")
def stim_indicator_by_user(spark, sf_dir):
    ev = _events(spark, sf_dir)
    s = ev.where("event_type = 'signup'")
    users, ends = s.select("user_id").distinct(), ev.agg(F.min("t").alias("a"), F.max("t").alias("b"))
    # Each user's row unrolls its own hours: the two ends are one row, so this join is a lookup.
    a, b = (F.floor(F.col(c) / _HOUR).cast("long") for c in ("a", "b"))
    grid = users.join(F.broadcast(ends)).select("user_id", F.explode(F.sequence(a, b + 4)).alias("hour")).alias("g")
    same = F.col("g.user_id").eqNullSafe(F.col("o.user_id")) & (F.col("g.hour") == F.col("o.hour"))
    return grid.join(_lit_hours(s, "user_id").alias("o"), same, "left").select("g.user_id", "g.hour", F.coalesce("stim", F.lit(0)).alias("stim"))


@query(f"""WITH {_EV} SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY t) AS trial, row_number() OVER (PARTITION BY user_id, event_type ORDER BY t) AS occurrence, lead(t) OVER (PARTITION BY user_id ORDER BY t) - 1 AS "end" FROM ev""")
def trial_ids(spark, sf_dir):
    return E.trials(_events(spark, sf_dir), "user_id", "t", "event_type").select("event_id", "trial", "occurrence", "end")


@query(f"""WITH {_EV}, o AS (SELECT user_id, t, min(value) AS v FROM ev GROUP BY 1, 2), e AS (SELECT user_id, min(t) AS a, max(t) AS b FROM o GROUP BY 1),
g AS (SELECT user_id, unnest(range(ceil(a / 21600000000)::BIGINT, floor(b / 21600000000)::BIGINT + 1)) * 21600000000 AS t FROM e),
x AS (SELECT g.user_id, g.t, p.t AS t1, p.v AS v1 FROM g ASOF JOIN o p ON g.user_id = p.user_id AND g.t >= p.t), y AS (SELECT x.*, n.t AS t2, n.v AS v2 FROM x ASOF JOIN o n ON x.user_id = n.user_id AND x.t <= n.t)
SELECT user_id, t, round(CASE WHEN t1 = t2 THEN v1 ELSE v1 + (v2 - v1) * (t - t1) / (t2 - t1) END, 6) AS v FROM y""")
def interp_linear(spark, sf_dir):
    return S.interpolated(_events(spark, sf_dir), "user_id", "t", "value", DAY // 4).withColumn("v", r6("v"))


@query(f"""WITH {_EV}, m AS (SELECT *, CASE WHEN event_id % 7 <> 0 THEN value END AS v FROM ev),
f AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p, first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n FROM m)
SELECT event_id, round(coalesce(v, (p + n) / 2, p, n), 6) AS filled FROM f""")
def gap_fill_mean(spark, sf_dir):
    rows = _events(spark, sf_dir).withColumn("v", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    return S.gap_filled(rows, "user_id", "t", "v").select("event_id", r6("filled").alias("filled"))


@query(f"WITH {_EV} SELECT event_id, round(quantile_cont(value, 0.2) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING), 6) AS p20 FROM ev")
def running_p20(spark, sf_dir):
    return S.running_percentile(_events(spark, sf_dir), "user_id", "t", "value", 0.2, 5).select("event_id", r6("running").alias("p20"))


@query(f"""WITH {_EV} SELECT event_id, coalesce(lead(value, 2) OVER w, 0) AS lag_m2, coalesce(lead(value, 1) OVER w, 0) AS lag_m1, value AS lag_p0, coalesce(lag(value, 1) OVER w, 0) AS lag_p1 FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY t)""")
def lag_matrix(spark, sf_dir):
    return S.lag_columns(_events(spark, sf_dir), "user_id", "t", "value", range(-2, 2)).select("event_id", "lag_m2", "lag_m1", "lag_p0", "lag_p1")


@query(f"""WITH {_EV}, c AS (SELECT event_id, user_id, t, sum(value) OVER (PARTITION BY user_id ORDER BY t) AS c FROM ev), d AS (SELECT event_id, user_id, t, c - lag(c) OVER (PARTITION BY user_id ORDER BY t) AS d FROM c)
SELECT event_id, round(coalesce(d, lead(d) OVER (PARTITION BY user_id ORDER BY t)), 6) AS velocity FROM d""")
def velocity(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("t")
    rows = _events(spark, sf_dir).withColumn("c", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("d", F.col("c") - F.lag("c").over(w))
    return rows.select("event_id", r6(F.coalesce("d", F.lead("d").over(w))).alias("velocity"))
