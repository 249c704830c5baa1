"""Queries on responses to stimuli, stimulus intervals and shifts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tracelake.operators import responses as P
from tracelake.operators import series as S
from tracelake.operators.columns import ratio
from tracelake.plans.frame_queries import _long
from tracelake.plans.registry import Registry
from tracelake.plans.signal_queries import _EV, _PAIRS, _TRIALS, DAY, _events, _pairs, _per_trial, r6
from tracelake.plans.table_queries import _LONG, _read

REGISTRY = Registry()
query = REGISTRY.query
HOUR = 3_600_000_000
Q = DAY // 4

_SIG = "sig AS (SELECT event_id, event_type = 'signup' AS onset, user_id, t, (value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0) AS raw, value AS pred FROM ev WINDOW w AS (PARTITION BY user_id))"


@query(f"""WITH {_EV}, {_SIG}, p AS (SELECT s.user_id, floor((s.t - o.t) / {Q})::BIGINT AS rel_bin, s.raw, s.pred FROM sig s JOIN sig o ON s.user_id = o.user_id AND o.onset AND NOT s.onset AND s.t - o.t >= -3 * {DAY} AND s.t - o.t < 3 * {DAY})
SELECT user_id, rel_bin, round(avg(raw), 6) AS raw, round(avg(pred), 6) AS pred, count(*) AS n FROM p GROUP BY 1, 2""")
def trial_average_z(spark, sf_dir):
    from tracelake.operators import events as E

    ev = P.zscored_by(_events(spark, sf_dir).withColumn("raw", F.col("value")), "user_id", ["raw"])
    onsets = ev.where("event_type = 'signup'").select("user_id", F.col("t").alias("onset"))
    pairs = E.within(ev.where("event_type <> 'signup'"), onsets, "user_id", 3 * DAY, 3 * DAY).withColumnRenamed("value", "pred")
    made = P.trial_average(pairs, ["user_id"], F.floor(F.col("rel") / Q).cast("long"), ["raw", "pred"])
    return made.select("user_id", "rel_bin", r6("raw").alias("raw"), r6("pred").alias("pred"), "n")


@query(f"WITH {_EV} SELECT s.event_id, count(*) AS n, min(o.event_id) AS first_onset FROM ev s JOIN ev o ON s.user_id = o.user_id AND o.event_type = 'signup' AND s.event_type <> 'signup' AND (s.t + {HOUR // 2}) // {HOUR} = (o.t + {HOUR // 2}) // {HOUR} GROUP BY 1")
def same_slot(spark, sf_dir):
    ev = _events(spark, sf_dir)
    onsets = ev.where("event_type = 'signup'").select("user_id", F.col("t").alias("onset"), F.col("event_id").alias("onset_id"))
    met = P.at_rounded_time(ev.where("event_type <> 'signup'"), onsets, "user_id", "t", HOUR)
    return met.groupBy("event_id").agg(F.count("*").alias("n"), F.min("onset_id").alias("first_onset"))


@query(f"WITH {_EV}, i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS i FROM ev) SELECT o.event_id, round(avg(s.value), 6) AS baseline, count(*) AS n FROM i o JOIN i s ON s.user_id = o.user_id AND o.event_type = 'signup' AND s.i - o.i BETWEEN -20 AND -1 GROUP BY 1")
def baseline_frames(spark, sf_dir):
    rows = _events(spark, sf_dir).withColumn("i", F.row_number().over(Window.partitionBy("user_id").orderBy("t", "event_id")))
    onsets = rows.where("event_type = 'signup'").select("user_id", F.col("i").alias("onset_index"), F.col("event_id").alias("onset_id"))
    met = P.frames_before(rows, onsets, "user_id", "i", 20)
    return met.groupBy(F.col("onset_id").alias("event_id")).agg(r6(F.avg("value")).alias("baseline"), F.count("*").alias("n"))


@query(f"WITH {_TRIALS}, n AS (SELECT user_id, user_id % 7 AS grp, (resp - base) / nullif(abs(base), 0) AS dff FROM tr), u AS (SELECT grp, user_id, median(dff) AS dff FROM n GROUP BY 1, 2) SELECT grp, round(median(dff), 6) AS dff FROM u GROUP BY 1")
def median_of_medians(spark, sf_dir):
    tr = _per_trial(_pairs(spark, sf_dir)).select("user_id", (F.col("user_id") % 7).alias("grp"), ratio(F.col("resp") - F.col("base"), F.abs("base")).alias("dff"))
    return P.median_over(tr, [["grp", "user_id"], ["grp"]], "dff").withColumn("dff", r6("dff"))


@query(f"WITH {_TRIALS} SELECT user_id, round(median((resp - base) / nullif(abs(base), 0)), 6) AS dff FROM tr GROUP BY 1")
def median_trials(spark, sf_dir):
    tr = _per_trial(_pairs(spark, sf_dir)).select("user_id", ratio(F.col("resp") - F.col("base"), F.abs("base")).alias("dff"))
    return P.median_over(tr, [["user_id"]], "dff").withColumn("dff", r6("dff"))


@query(f"""WITH {_LONG}, b AS (SELECT i, avg(v) AS m, stddev_samp(v) AS s FROM e WHERE vec_id < 100 GROUP BY 1)
SELECT vec_id, (i - 1) % 8 AS x, round(max(v - m), 6) AS max_df, round(max((v - m) / nullif(m, 0)), 4) AS max_dff, round(max(v), 6) AS max_f, round(max((v - m) / nullif(s, 0)), 6) AS max_snr FROM e JOIN b USING (i) GROUP BY 1, 2""")
def max_projection(spark, sf_dir):
    rows = _long(spark, sf_dir)
    base = rows.where("vec_id < 100").groupBy("i").agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s"))
    made = P.projections(rows.join(base, "i").withColumn("x", (F.col("i") - 1) % 8), ["vec_id", "x"], "i", "v", "m", "s")
    return made.select("vec_id", "x", r6("max_df").alias("max_df"), F.round("max_dff", 4).alias("max_dff"), r6("max_f").alias("max_f"), r6("max_snr").alias("max_snr"))


@query(f"WITH {_LONG}, h AS (SELECT label, floor((v + 1) * 10)::BIGINT AS bin, count(*) AS n FROM e GROUP BY 1, 2) SELECT label, bin, n, round(n / max(n) OVER (PARTITION BY label), 6) AS by_max FROM h")
def hist_by_segment(spark, sf_dir):
    counts = _long(spark, sf_dir).groupBy("label", F.floor((F.col("v") + 1) * 10).alias("bin")).agg(F.count("*").alias("n"))
    return counts.withColumn("by_max", r6(F.col("n") / F.max("n").over(Window.partitionBy("label"))))


@query(f"WITH {_LONG}, f AS (SELECT vec_id, label, max(v) AS m, avg(v) AS a FROM e GROUP BY 1, 2) SELECT label, CASE WHEN count(*) FILTER (m > 0.3) >= 2 THEN round(avg(a) FILTER (m > 0.3), 6) END AS mean, count(*) FILTER (m > 0.3) AS n FROM f GROUP BY 1")
def bright_frames(spark, sf_dir):
    frames = _long(spark, sf_dir).groupBy("vec_id", "label").agg(F.max("v").alias("m"), F.avg("v").alias("a"))
    return P.bright_mean(frames, ["label"], "m", "a", 0.3, 2).withColumn("mean", r6("mean"))


@query(f"""WITH {_EV}, i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS i FROM ev), p AS (SELECT user_id, i AS at, floor(value / 10)::BIGINT AS width FROM i WHERE event_type = 'signup'),
m AS (SELECT width FROM p GROUP BY 1 ORDER BY count(*) DESC, width LIMIT 1)
SELECT (i.i - p.at)::INT AS "offset", round(avg(i.value), 6) AS mean, count(*) AS n FROM p JOIN m USING (width) JOIN i ON i.user_id = p.user_id AND i.i - p.at BETWEEN -5 AND 8 GROUP BY 1""")
def pulse_triggered(spark, sf_dir):
    rows = _events(spark, sf_dir).withColumn("i", F.row_number().over(Window.partitionBy("user_id").orderBy("t", "event_id")))
    pulses = rows.where("event_type = 'signup'").select("user_id", F.col("i").alias("at"), F.floor(F.col("value") / 10).alias("width"))
    return P.triggered_average(rows, pulses, "user_id", "i", "value", 5, 8).withColumn("mean", r6("mean"))


@query(f"WITH {_EV}, b AS (SELECT user_id, median(value) FILTER (event_type = 'view') AS m FROM ev GROUP BY 1) SELECT event_id, round(value - m, 6) AS corrected FROM ev JOIN b USING (user_id)")
def less_baseline_median(spark, sf_dir):
    made = P.subtracted(_events(spark, sf_dir), "user_id", F.col("event_type") == "view", F.col("value"), "median")
    return made.select("event_id", r6("corrected").alias("corrected"))


@query(f"""WITH {_EV}, b AS (SELECT user_id, avg(value) FILTER (t < 5 * {DAY}) AS m FROM ev GROUP BY 1), a AS (SELECT user_id, t FROM ev JOIN b USING (user_id) WHERE abs(value - m) > 10),
g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) < {DAY} THEN 0 ELSE 1 END AS new FROM a), r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t) AS run FROM g)
SELECT user_id, min(t) AS "first", max(t) AS "last", count(*) AS n FROM r GROUP BY user_id, run""")
def ttl_intervals(spark, sf_dir):
    return P.pulses_above(_events(spark, sf_dir), "user_id", "t", F.col("value"), 5 * DAY, 10.0, DAY)


@query(f"""WITH {_EV}, k AS (SELECT event_type, min(length(event_type)) * 10 AS length FROM ev GROUP BY 1), p AS (SELECT e.*, k.length, coalesce(sum(k.length) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM ev e JOIN k USING (event_type)),
a AS (SELECT user_id, s + u AS t FROM p, (SELECT unnest([0, 1, 2, 20, 21]) AS u)), g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) < 15 THEN 0 ELSE 1 END AS new FROM a), r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t) AS run FROM g)
SELECT user_id, min(t)::BIGINT AS "first", max(t)::BIGINT AS "last", count(*) AS n FROM r GROUP BY user_id, run""")
def template_intervals(spark, sf_dir):
    ev = _events(spark, sf_dir)
    active = F.array(*[F.lit(i) for i in (0, 1, 2, 20, 21)])
    templates = ev.select("event_type").distinct().select("event_type", (F.length("event_type") * 10).alias("length"), active.alias("active"))
    made = P.template_onsets(ev.select("user_id", "event_id", "event_type"), templates, "user_id", "event_id", "event_type", 15)
    return made.select("user_id", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), "n")


@query(f"""WITH {_EV} SELECT user_id, t, t + 101 AS onset, lead(t) OVER (PARTITION BY user_id ORDER BY t) - 50 AS "offset" FROM ev WHERE event_type = 'click'""")
def logged_intervals(spark, sf_dir):
    return P.logged_onsets(_events(spark, sf_dir).where("event_type = 'click'"), "user_id", "t", 100, 50)


@query(f"""WITH {_EV}, p AS (SELECT user_id, event_type, min(t) AS a, max(t) AS b FROM ev GROUP BY 1, 2) SELECT user_id, (ceil(max(a) / {HOUR}) * {HOUR})::BIGINT AS "first", (floor(min(b) / {HOUR}) * {HOUR})::BIGINT AS "last" FROM p GROUP BY 1""")
def shared_range(spark, sf_dir):
    return P.common_range(_events(spark, sf_dir), ["user_id"], "event_type", "t", HOUR)


_SH = "i AS (SELECT event_id, user_id, value::DOUBLE AS x, row_number() OVER w AS i, count(*) OVER (PARTITION BY user_id) AS n, list(value::DOUBLE) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS v FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))"


@query(f"""WITH {_EV}, {_SH}, s AS (SELECT *, list_avg(v[i - least(2, i - 1, n - i) : i + least(2, i - 1, n - i)]) AS s FROM i), b AS (SELECT user_id, max(abs(x - s)) > 90 OR sum(abs(x - s)) > 900 AS bad FROM s GROUP BY 1)
SELECT event_id, round(CASE WHEN bad THEN 0 ELSE s END, 6) AS smooth_x FROM s JOIN b USING (user_id)""")
def checked_shifts(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "user_id", F.struct("t", "event_id").alias("o"), F.col("value").cast("double").alias("x"))
    return P.repaired_shift(rows, "user_id", "o", ["x"], 5, 90.0, 900.0).select("event_id", r6("smooth_x").alias("smooth_x"))


@query(f"WITH {_LONG} SELECT vec_id, round(sum(v) FILTER (i % 2 = 1) * 0.5, 6) AS x, round(sum(v) FILTER (i % 2 = 0) * 2, 6) AS y FROM e GROUP BY 1")
def total_shifts(spark, sf_dir):
    rows = _long(spark, sf_dir).select("vec_id", F.when(F.col("i") % 2 == 1, F.col("v")).alias("x"), F.when(F.col("i") % 2 == 0, F.col("v")).alias("y"))
    return P.summed_shifts(rows, ["vec_id"], ["x", "y"], {"x": 0.5, "y": 2.0}).select("vec_id", r6("x").alias("x"), r6("y").alias("y"))


@query(f"WITH {_LONG} SELECT vec_id, round(avg(v), 6) AS x, 0.0::DOUBLE AS z FROM e GROUP BY 1")
def plane_mean_shifts(spark, sf_dir):
    return P.mean_shifts(_long(spark, sf_dir).withColumns({"x": F.col("v"), "z": F.col("i")}), ["vec_id"], ["x", "z"], ("z",)).withColumn("x", r6("x"))


@query(f"WITH {_LONG} SELECT vec_id, round((quantile_cont(v, 0.9) - quantile_cont(v, 0.1)) / max(abs(v)), 6) AS score FROM e GROUP BY 1 HAVING (quantile_cont(v, 0.9) - quantile_cont(v, 0.1)) / max(abs(v)) > 1.0")
def responsive_series(spark, sf_dir):
    return P.responsive(_long(spark, sf_dir), "vec_id", "v", 0.1, 0.9, 1.0, F.max(F.abs("v"))).withColumn("score", r6("score"))


@query(f"WITH {_LONG} SELECT label, i, round(avg(v), 6) AS mean, count(DISTINCT vec_id % 13) AS individuals FROM e GROUP BY 1, 2")
def cluster_traces(spark, sf_dir):
    rows = _long(spark, sf_dir).withColumn("individual", F.col("vec_id") % 13)
    return P.cluster_traces(rows, "label", "i", "v", "individual").withColumn("mean", r6("mean"))


@query("WITH f AS (SELECT label, min(vec_id) AS a FROM embeddings GROUP BY 1), n AS (SELECT label, row_number() OVER (ORDER BY a, label) AS new_label FROM f) SELECT vec_id, new_label FROM embeddings JOIN n USING (label)")
def labels_in_order(spark, sf_dir):
    return P.relabelled(_read(spark, sf_dir, "embeddings").select("vec_id", "label"), "label", "vec_id").select("vec_id", "new_label")


@query(f"""WITH {_LONG}, q AS (SELECT vec_id, i, v * v / nullif(sum(v * v) OVER (PARTITION BY vec_id), 0) AS q, max(i) OVER (PARTITION BY vec_id) AS n FROM e),
k AS (SELECT vec_id, i, least(2, i - 1, n - i) AS h FROM q) SELECT k.vec_id, k.i, round(avg(q.q), 6) AS v FROM k JOIN q ON q.vec_id = k.vec_id AND q.i BETWEEN k.i - k.h AND k.i + k.h GROUP BY 1, 2""")
def smooth_energy(spark, sf_dir):
    from tracelake.plans.table_queries import _array_query

    return _array_query(spark, sf_dir, S.smoothed_energy(F.col("x"), 5))


@query("SELECT event_id, round(sqrt(CASE WHEN value >= 0 THEN value END), 6) AS root FROM events")
def square_roots(spark, sf_dir):
    return _read(spark, sf_dir, "events").select("event_id", r6(F.when(F.col("value") >= 0, F.sqrt("value"))).alias("root"))


@query(f"WITH {_LONG}, m AS (SELECT label, i, avg(v) AS m FROM e GROUP BY 1, 2) SELECT vec_id, round(sum(v * m), 6) AS dot, arg_max(i, v) AS argmax, arg_min(i, v) AS argmin, count(DISTINCT round(v, 1)) AS n_levels FROM e JOIN m USING (label, i) GROUP BY 1")
def row_products(spark, sf_dir):
    rows = _long(spark, sf_dir)
    mean = rows.groupBy("label", "i").agg(F.avg("v").alias("m"))
    met = rows.join(mean, ["label", "i"]).groupBy("vec_id")
    return met.agg(r6(F.sum(F.col("v") * F.col("m"))).alias("dot"), F.max_by("i", F.struct("v", -F.col("i"))).alias("argmax"), F.min_by("i", F.struct("v", "i")).alias("argmin"), F.count_distinct(F.round("v", 1)).alias("n_levels"))


@query("SELECT n_regionkey AS cohort, c_nationkey AS rec, round(avg(c_acctbal::DOUBLE), 6) AS speed, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2")
def cohort_means(spark, sf_dir):
    met = _read(spark, sf_dir, "customer").join(_read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return met.groupBy(F.col("n_regionkey").alias("cohort"), F.col("c_nationkey").alias("rec")).agg(r6(F.avg(F.col("c_acctbal").cast("double"))).alias("speed"), F.count("*").alias("n"))


@query(f"WITH {_EV}, v AS (SELECT DISTINCT event_type FROM ev WHERE value > 60), w AS (SELECT * FROM (VALUES ('click'), ('signup'), ('absent')) AS t(event_type)) SELECT event_id FROM ev WHERE event_type IN (SELECT event_type FROM w INTERSECT SELECT event_type FROM v)")
def requested_kinds(spark, sf_dir):
    ev = _events(spark, sf_dir)
    wanted = spark.createDataFrame([("click",), ("signup",), ("absent",)], "event_type string")
    return ev.join(wanted.intersect(ev.where("value > 60").select("event_type")), "event_type", "left_semi").select("event_id")
