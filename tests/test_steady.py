"""Results that must not hang on the order of rows."""

import random

from pyspark.sql import functions as F

from tracelake.operators.responses import pulses_above


def test_threshold_at_the_mean(spark):
    """A value exactly `level` above the mean is not above it, in whatever order the mean's values are summed."""
    base = [48.61, 0.1, 0.2, 77.7, 3.33, 12.08, 99.99, 0.03, 55.55, 20.01] * 3 + [d / 100 for d in range(1, 200, 7)]
    rng, rows = random.Random(1), []
    for k in range(200):
        own = list(base)
        rng.shuffle(own)
        # The last makes the mean 30 exactly.
        own.append(round(30 * (len(own) + 1) - sum(own), 2))
        rows += [(k, i, v) for i, v in enumerate(own)] + [(k, 1000, 40.0), (k, 2000, 20.0), (k, 3000, 40.01)]
    df = spark.createDataFrame(rows, "k int, t long, v double").coalesce(1)
    got = pulses_above(df, "k", "t", F.col("v"), 1000, 10.0, 5).where("first >= 1000").collect()
    assert sorted((r.k, r["first"], r.n) for r in got) == [(k, 3000, 1) for k in range(200)]
    plain = df.where("t < 1000").groupBy("k").agg(F.avg("v").alias("m")).where("m <> 30").count()
    assert plain > 0  # so this test is one of rounding
