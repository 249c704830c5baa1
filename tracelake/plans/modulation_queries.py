"""Queries on how stimuli drive series: lagged ridge models and the null distributions of their fit."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.functions.shared import stored
from tracelake.operators import nulls, ridge, stats
from tracelake.operators.columns import ticks
from tracelake.plans.registry import Registry
from tracelake.plans.signal_queries import r6

REGISTRY = Registry()
query = REGISTRY.query

HOUR, FOLDS, LAGS = 3_600_000_000, 4, range(4)
STIMULI = {"signup": "a", "purchase": "b"}


def _recording(spark, sf_dir):
    """samples (user_id, t, y): each user's value by hour; design (t, a, b): how often each stimulus came in each hour of the table."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", F.floor(ticks() / HOUR).alias("t"), "event_type", "value")
    samples = rows.groupBy("user_id", "t").agg(F.sum("value").alias("y"))
    counts = rows.groupBy("t").agg(*[F.count_if(F.col("event_type") == e).alias(c) for e, c in STIMULI.items()])
    hours = rows.agg(F.min("t").alias("low"), F.max("t").alias("high")).select("low", "high", F.explode(F.sequence("low", "high")).alias("t"))
    design = hours.join(counts, "t", "left").fillna(0, list(STIMULI.values()))
    return samples, design.withColumn("fold", F.floor((F.col("t") - F.col("low")) * FOLDS / (F.col("high") - F.col("low") + 1)).cast("int"))


def _lagged(spark, sf_dir):
    samples, design = _recording(spark, sf_dir)
    return samples, ridge.lagged(design, "t", list(STIMULI.values()), LAGS).join(design.select("t", "fold"), "t")


def _fitted(samples, design):
    return ridge.fitted(samples, design, "user_id", "t", "y", {c: len(LAGS) for c in STIMULI.values()})


_GRID = f"""s AS (SELECT user_id, epoch_us(ts) // {HOUR} AS t, sum(value) AS y FROM events GROUP BY 1, 2),
h AS (SELECT unnest(range((SELECT min(t) FROM s), (SELECT max(t) FROM s) + 1)) AS t),
c AS (SELECT epoch_us(ts) // {HOUR} AS t, count(*) FILTER (event_type = 'signup') AS a, count(*) FILTER (event_type = 'purchase') AS b FROM events GROUP BY 1),
d AS (SELECT t, coalesce(a, 0)::DOUBLE AS a, coalesce(b, 0)::DOUBLE AS b, t - min(t) OVER () AS i, count(*) OVER () AS n FROM h LEFT JOIN c USING (t)),
g AS (SELECT user_id, t, i, n, coalesce(y, 0) AS y, a, b FROM (SELECT DISTINCT user_id FROM s) CROSS JOIN d LEFT JOIN s USING (user_id, t))"""


@query(f"""WITH {_GRID}, f AS (SELECT unnest(range(0, {FOLDS})) AS f),
m AS (SELECT user_id, f, count(*) FILTER (NOT own) AS k, corr(a, y) FILTER (NOT own) AS ay, corr(b, y) FILTER (NOT own) AS by_, corr(a, b) FILTER (NOT own) AS ab,
  corr(a, y) FILTER (own) AS tay, corr(b, y) FILTER (own) AS tby, corr(a, b) FILTER (own) AS tab FROM (SELECT *, i * {FOLDS} // n = f AS own FROM g, f) GROUP BY 1, 2),
w AS (SELECT *, k * ((k + 10) * ay - k * ab * by_) / ((k + 10) ** 2 - (k * ab) ** 2) AS u, k * ((k + 10) * by_ - k * ab * ay) / ((k + 10) ** 2 - (k * ab) ** 2) AS v FROM m)
SELECT user_id, round(avg(coalesce((u * tay + v * tby) / sqrt(u * u + v * v + 2 * u * v * tab), 0)), 6) AS r, round(avg(coalesce(u, 0)), 6) AS filter_a, round(avg(coalesce(v, 0)), 6) AS filter_b FROM w GROUP BY 1""")
def stim_ridge_fixed(spark, sf_dir):
    samples, design = _recording(spark, sf_dir)
    found = ridge.fitted(samples, design.select("t", "fold", F.array("a", "b").cast("array<double>").alias("x")), "user_id", "t", "y", {"a": 1, "b": 1}, penalty=10.0)
    return found.select("user_id", r6("r").alias("r"), r6(F.get("filter", F.lit(0))).alias("filter_a"), r6(F.get("filter", F.lit(1))).alias("filter_b"))


@query()
def stim_ridge(spark, sf_dir):
    """Marginal-likelihood penalties, held-out fit, rank and what each stimulus adds."""
    found = _fitted(*_lagged(spark, sf_dir))
    return found.select("user_id", "r", "r2", "penalty", "rank", *[F.try_element_at("unique", F.lit(c)).alias(f"unique_{c}") for c in STIMULI.values()])


def _null(spark, sf_dir, **options):
    """(user_id, obs, p, adjusted, reject) of the model's fit against its permuted series."""
    samples, design = _lagged(spark, sf_dir)
    rows = stored(ridge.with_arrays(samples, _fitted(samples, design), design, "user_id", "t", "y"))
    null = nulls.null_correlations(rows, "user_id", "y", "predicted", **options)
    found = nulls.observed(rows, "user_id", "y", "predicted").withColumnRenamed("r", "obs")
    # Stored, as the correction reads it more than once.
    tested = stored(stats.permutation_p(found, null.select("user_id", F.col("r").alias("null_value")), ["user_id"]))
    return stats.false_discovery(tested.withColumn("f", F.lit(1)), ["f"], "p").select("user_id", "obs", "p", "adjusted", "reject")


@query()
def ridge_null(spark, sf_dir):
    return _null(spark, sf_dir, kind="chunk")


@query()
def shuffle_null(spark, sf_dir):
    return _null(spark, sf_dir, kind="shuffle")


@query()
def surrogate_null(spark, sf_dir):
    return _null(spark, sf_dir, kind="surrogate", count=100)


@query()
def shuffled_filters(spark, sf_dir):
    """Mean, median and deviation of each weight over refits on shuffled series."""
    samples, design = _lagged(spark, sf_dir)
    refits = nulls.filtering(spark, ridge.standardised(design, "t"), "user_id", samples.schema["user_id"].dataType.simpleString(), penalty=10.0, count=100)
    return ridge.with_arrays(samples, _fitted(samples, design), design, "user_id", "t", "y", then=refits)


LEAST_SHIFT = 10


@query(f"""WITH {_GRID}, k AS (SELECT unnest(range({LEAST_SHIFT}, (SELECT any_value(n) FROM d) - {LEAST_SHIFT} + 1)) AS k),
m AS (SELECT user_id, avg(y) AS my, stddev_pop(y) AS sy FROM g GROUP BY 1 HAVING stddev_pop(y) > 0), e AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa FROM d),
x AS (SELECT s.user_id, k, mirrored, sum(y * CASE WHEN mirrored THEN u.a ELSE v.a END) AS xy FROM (SELECT s.*, i, n FROM s JOIN d USING (t)) s, k, (SELECT unnest([false, true]) AS mirrored)
  JOIN d v ON v.i = (s.i + k) % s.n JOIN d u ON u.i = s.n - 1 - (s.i + k) % s.n GROUP BY 1, 2, 3),
r AS (SELECT user_id, (xy / (SELECT any_value(n) FROM d) - my * ma) / (sy * sa) AS r FROM x JOIN m USING (user_id), e)
SELECT user_id, count(*) AS n, round(avg(r), 6) AS mean_r, round(min(r), 6) AS least_r, round(max(r), 6) AS most_r FROM r GROUP BY 1""")
def circular_null(spark, sf_dir):
    """All rotations and mirrored rotations of each user's series against the first stimulus."""
    samples, design = _recording(spark, sf_dir)
    plain = design.select("t", F.array("a").cast("array<double>").alias("x"))
    users = samples.select("user_id").distinct().withColumn("filter", F.array(F.lit(1.0)))
    length = design.count()
    every = len(nulls.rotations(length, LEAST_SHIFT))
    turned = nulls.correlating("user_id", samples.schema["user_id"].dataType.simpleString(), kind="circular", count=every, least=LEAST_SHIFT, batch=200)
    null = ridge.with_arrays(samples, users, plain, "user_id", "t", "y", then=turned).where("r is not null")
    return null.groupBy("user_id").agg(F.count("*").alias("n"), r6(F.avg("r")).alias("mean_r"), r6(F.min("r")).alias("least_r"), r6(F.max("r")).alias("most_r"))

