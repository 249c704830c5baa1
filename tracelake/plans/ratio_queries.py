"""Queries on two channels of an image: quantities and prices of items as pixels, by order and line."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.operators import ratio
from tracelake.plans.registry import Registry
from tracelake.plans.signal_queries import r6

REGISTRY = Registry()
query = REGISTRY.query
#: Orders an image, and the least quantity that counts.
ORDERS, FLOOR = 1000, 5.0


def _pixels(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("quantity"), F.max("l_extendedprice").alias("price"))
    key = F.col("l_orderkey").cast("long")
    return rows.select(F.floor(key / ORDERS).alias("image"), (key % ORDERS).alias("y"), F.col("l_linenumber").cast("long").alias("x"), F.col("quantity").cast("double").alias("quantity"), F.col("price").cast("double").alias("price"))


def _scored_sql() -> str:
    """The rounds of the fit, written out one after the other."""
    r = "slope * u + level - v"
    sd = f"CASE WHEN count(*) FILTER ({r} < 0) = 1 THEN 0 ELSE stddev_samp({r}) FILTER ({r} < 0) END"
    parts = [f"""p AS MATERIALIZED (SELECT l_orderkey::BIGINT // {ORDERS} AS image, l_orderkey::BIGINT % {ORDERS} AS y, l_linenumber::BIGINT AS x, max(l_quantity)::DOUBLE AS q, max(l_extendedprice)::DOUBLE AS c FROM lineitem GROUP BY l_orderkey, l_linenumber),
a AS (SELECT image, y, x, (q - min(q) OVER w) / max(q) OVER w AS u, (c - min(c) OVER w) / max(c) OVER w AS v FROM p WHERE q > {FLOOR} WINDOW w AS (PARTITION BY image)),
b AS MATERIALIZED (SELECT * FROM a WHERE u > {ratio.NONE} AND v > {ratio.NONE}),
g AS (SELECT image, avg(u) + 1000 * coalesce(stddev_samp(u), 0) AS far FROM b GROUP BY 1),
t AS MATERIALIZED (SELECT b.* FROM b JOIN g USING (image) WHERE u <= far),
l0 AS (SELECT DISTINCT image, NULL::DOUBLE AS slope, NULL::DOUBLE AS level, NULL::DOUBLE AS most FROM t)"""]
    rounds = ratio.cutoffs(0.7, 0.02)
    for i, least in enumerate(rounds, 1):
        keep = f"v >= {least!r}::DOUBLE AND coalesce({r} <= most, true)"
        parts.append(f"f{i} AS MATERIALIZED (SELECT image, regr_slope(v, u) FILTER ({keep}) AS slope, regr_intercept(v, u) FILTER ({keep}) AS level FROM t JOIN l{i - 1} USING (image) GROUP BY 1)")
        parts.append(f"l{i} AS MATERIALIZED (SELECT image, any_value(slope) AS slope, any_value(level) AS level, 3 * {sd} AS most FROM t JOIN f{i} USING (image) GROUP BY 1)")
    parts.append(f"k AS MATERIALIZED (SELECT t.* FROM t JOIN l{len(rounds)} USING (image) WHERE coalesce({r} <= most, true))")
    parts.append("z AS MATERIALIZED (SELECT image, regr_slope(v, u) AS slope, regr_intercept(v, u) AS level FROM k GROUP BY 1)")
    parts.append(f"e AS (SELECT image, any_value(slope) AS slope, any_value(level) AS level, {sd} AS below FROM k JOIN z USING (image) GROUP BY 1)")
    return f"WITH {', '.join(parts)} SELECT image, y, x, round(({r}) / nullif(below, 0), 6) AS score FROM t JOIN e USING (image)"


@query(_scored_sql())
def ratio_scores(spark, sf_dir):
    """How far below its image's line of price by quantity each item lies."""
    return ratio.scores(_pixels(spark, sf_dir), "image", "quantity", "price", FLOOR).select("image", "y", "x", r6("score").alias("score"))


@query()
def ratio_mask(spark, sf_dir):
    """Components of five items or more that lie half a deviation or more below the line."""
    rows = _pixels(spark, sf_dir)
    return ratio.mask(ratio.scores(rows, "image", "quantity", "price", FLOOR), rows, "image", threshold=0.5, size=3, least=5, last=5)
