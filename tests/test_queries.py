"""Operators on literals, and every signal query against its SQL."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from tracelake.operators import events, series, stats
from tracelake.operators.columns import midpoint_percentile
from tracelake.plans import catalogue

SF = "/root/testdata/sf0.001"


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else round(v, 5) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_matches_sql(spark, name):
    db = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "labels"):
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = catalogue.QUERIES[name](spark, SF)
    want = db.execute(catalogue.ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    order = lambda rows: sorted((tuple(map(plain, r)) for r in rows), key=str)
    assert order(got.select(*columns).collect()) == order(want.fetchall())


def test_holm_golden_value(spark):
    df = spark.createDataFrame(list(enumerate([0.56, 0.22, 0.001, 0.04, 0.01])), "i int, p double").withColumn("f", F.lit(1))
    got = [(round(r.adjusted, 9), r.reject) for r in stats.holm(df, ["f"], "p", "i").orderBy("i").collect()]
    assert got == [(0.56, False), (0.44, False), (0.005, True), (0.12, False), (0.04, True)]


def test_midpoint_percentile(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],), ([],), ([None, 5.0],)], "v array<double>")
    assert [r.p for r in df.select(midpoint_percentile(F.col("v"), 25).alias("p")).collect()] == [1.5, None, 5.0]


def test_nearest_takes_the_earlier_on_ties(spark):
    left = spark.createDataFrame([(1, 10), (1, 14), (2, 5)], "k long, t long")
    right = spark.createDataFrame([(1, 8, 80), (1, 12, 120)], "k long, t long, id long")
    got = sorted((r.k, r.t, r.near_t, r.near_id) for r in events.nearest(left, right, "k", "t", "id").collect() if r.near_t)
    assert got == [(1, 10, 8, 80), (1, 14, 12, 120)]


def test_blur_of_an_impulse_sums_to_one_inside(spark):
    df = spark.createDataFrame([([0.0] * 5 + [1.0] + [0.0] * 5,)], "v array<double>")
    out = df.select(series.blurred(F.col("v"), 1.0, 5).alias("b")).first().b
    assert abs(sum(out) - 1) < 1e-12 and out[5] == max(out) and out[2] == 0


def test_zscore_of_a_constant_is_null(spark):
    df = spark.createDataFrame([([2.0, 2.0],), ([1.0, 3.0],)], "v array<double>")
    assert [r.z for r in df.select(series.zscored(F.col("v")).alias("z")).collect()] == [[None, None], [-1.0, 1.0]]


def test_stim_indicator_by_user_leaves_no_signup_out(spark):
    signups = spark.read.parquet(f"{SF}/events.parquet").where("event_type = 'signup'")
    got = catalogue.QUERIES["stim_indicator_by_user"](spark, SF)
    lit = {r.user_id for r in got.where("stim = 1").select("user_id").distinct().collect()}
    assert lit == {r.user_id for r in signups.select("user_id").distinct().collect()} and any(u % 50 for u in lit)


def test_stim_indicator_takes_all_signups_over_the_tables_hours(spark):
    hour = 3_600_000_000
    db = duckdb.connect()
    times = db.execute(f"select epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01'), event_type from '{SF}/events.parquet'").fetchall()
    hours = range(min(t for t, _ in times) // hour, max(t for t, _ in times) // hour + 5)
    lit = {h for t, kind in times if kind == "signup" for h in range(-(-t // hour), -(-(t + 4 * hour) // hour))}
    got = {r.hour: r.stim for r in catalogue.QUERIES["stim_indicator"](spark, SF).collect()}
    assert got == {h: int(h in lit) for h in hours}


def test_running_totals_do_not_depend_on_the_number_of_ranges(spark):
    rows = [(f, v, v % 7) for f in (None, "a", "b") for v in range(40)] + [("a", 3, 1), ("b", None, 2)]
    df = spark.createDataFrame(rows, "f string, v int, n int")
    place = lambda v: -1 if v is None else v
    for down, ranges in ((False, None), (True, None), (False, 7), (True, 7)):
        got = stats.running(stats.in_ranges(df, ["f"], ["v"], ranges), ["f"], ["v"], "s", F.col("n"), down=down)
        assert not ranges or got.select("_block").distinct().count() > 1
        want = [(f, v, n, sum(m for g, u, m in rows if g == f and (place(u) >= place(v) if down else place(u) <= place(v)))) for f, v, n in rows]
        assert sorted(got.select("f", "v", "n", "s").collect(), key=str) == sorted((spark.createDataFrame(want, "f string, v int, n int, s long").collect()), key=str)


def test_corrections_of_nulls_ties_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 0.01), ("a", 0.01), ("a", None), (None, 0.5), ("b", None)], "f string, p double")
    got = {(r.f, r.p): (r.adjusted, r.critical_p, r.reject) for r in stats.false_discovery(df, ["f"], "p").collect()}
    assert got == {("a", 0.01): (0.01, 0.01, True), ("a", None): (None, 0.01, None), (None, 0.5): (0.5, 0.0, False), ("b", None): (None, 0.0, None)}
    assert stats.false_discovery(df, ["f"], "p").count() == 5
    assert stats.false_discovery(df.where("false"), ["f"], "p").count() == stats.holm(df.where("false"), ["f"], "p", "f").count() == 0


def test_harmonic_series_beyond_its_switch(spark):
    for n in (0, 1, 1000, 1001, 50_000):
        got = spark.range(1).select(stats.harmonic(F.lit(n).cast("long")).alias("h")).first().h
        assert abs(got - sum(1 / i for i in range(1, n + 1))) < 1e-11
