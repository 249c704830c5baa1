"""Null distributions and fits in slices: whole series meet numpy's, however long and however many there are."""

import numpy as np

from tracelake.operators import nulls, ridge


def test_observed_correlations_of_long_series(spark):
    """The time is linear in the length (over its square before, element by element)."""
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=50_000).tolist(), rng.normal(size=50_000).tolist()) for k in range(3)] + [(7, [1.0, 2.0], [1.0, 1.0]), (8, None, [1.0])]
    got = {r.k: r.r for r in nulls.observed(spark.createDataFrame(rows, "k long, y array<double>, p array<double>"), "k", "y", "p").collect()}
    assert got[7] is None and got[8] is None and all(abs(got[k] - np.corrcoef(y, p)[0, 1]) < 1e-12 for k, y, p in rows[:3])


def test_slices_keep_every_series(spark, monkeypatch):
    """More series than are worked on at a time, and orders that aren't all held, give what one at a time gives."""
    monkeypatch.setattr(nulls, "HELD", 100)
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=30).tolist(), rng.normal(size=30).tolist()) for k in range(600)]
    df = spark.createDataFrame(rows, "k long, y array<double>, p array<double>").coalesce(1)
    got = {(r.k, r.number): r.r for r in nulls.null_correlations(df, "k", "y", "p", "shuffle", count=12, seed=4, batch=5, first=3).collect()}
    assert set(got) == {(k, i) for k in range(600) for i in range(3, 12)}
    for k in (0, 255, 256, 599):
        assert all(abs(got[k, i] - np.corrcoef(np.array(rows[k][1])[nulls.shuffled(30, 4, i)], rows[k][2])[0, 1]) < 1e-12 for i in range(3, 12))
    assert nulls.null_filters(df, rng.normal(size=(30, 2)), "k", "y", 1.0, count=5).count() == 1200


def test_equal_values_need_no_order():
    rng = np.random.default_rng(3)
    for least in (0.0, -1.0):
        x = np.where(rng.random(200) < 0.1, rng.normal(size=200) + least, 0.0)
        made = nulls.surrogates(x, 5, range(4))
        assert np.array_equal(np.sort(made, axis=1), np.broadcast_to(np.sort(x), made.shape))


def test_arrays_of_samples(spark):
    """Samples at the design's times; a series without samples is zero, and other times count for nothing."""
    design = spark.createDataFrame([(t, [float(t), float(t % 3)]) for t in range(10)], "t long, x array<double>")
    samples = spark.createDataFrame([(k, t, float(k + t)) for k in range(300) for t in (2, 5, 40)], "k long, t long, y double")
    filters = spark.createDataFrame([(k, [1.0, -1.0]) for k in range(301)], "k long, filter array<double>")
    got = {r.k: r for r in ridge.with_arrays(samples, filters, design, "k", "t", "y").collect()}
    want = ridge.standardised(design, "t") @ [1.0, -1.0]
    assert len(got) == 301 and not any(got[300].y) and all(np.allclose(r.predicted, want) for r in got.values())
    assert all(got[k].y == [float(k + t) if t in (2, 5) else 0.0 for t in range(10)] for k in range(300))


def test_surrogates_of_equal_series_are_made_once_in_a_place(spark, monkeypatch, tmp_path):
    """Series that are equal meet, so the work is that of the distinct ones; r is each series' own."""
    made = nulls.surrogates

    def counted(x, seed, numbers):
        (tmp_path / f"{hash(x.tobytes())}-{numbers.start}-{np.random.default_rng().integers(1 << 60)}").touch()
        return made(x, seed, numbers)

    monkeypatch.setattr(nulls, "surrogates", counted)
    rng = np.random.default_rng(4)
    kinds = [np.where(rng.random(60) < 0.3, rng.normal(size=60), 0.0) for _ in range(5)]
    rows = [(k, kinds[k % 5].tolist(), rng.normal(size=60).tolist()) for k in range(200)]
    df = spark.createDataFrame(rows, "k long, y array<double>, p array<double>")
    got = {(r.k, r.number): r.r for r in nulls.null_correlations(df, "k", "y", "p", "surrogate", count=6, seed=2).collect()}
    assert len(got) == 1200
    for k in (0, 7, 199):
        want = [np.corrcoef(x, rows[k][2])[0, 1] for x in made(kinds[k % 5], 2, range(6))]
        assert np.allclose([got[k, i] for i in range(6)], want)
    # One for each of 200 series before.
    assert len(list(tmp_path.iterdir())) <= 5 * 4


def test_nulls_take_arrays_in_the_task_that_makes_them(spark):
    """Arrays that become rows between two functions come in batches of thousands."""
    from tracelake.plans import catalogue

    for name in ("circular_null", "shuffled_filters"):
        plan = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1


def test_arrays_handed_on_are_those_of_rows(spark):
    design = spark.createDataFrame([(t, [float(t % 7), float(t % 3)]) for t in range(40)], "t long, x array<double>")
    samples = spark.createDataFrame([(k, t, float((k * 7 + t * 5) % 11)) for k in range(300) for t in range(0, 40, 3)], "k long, t long, y double")
    filters = spark.createDataFrame([(k, [1.0, -0.5]) for k in range(301)], "k long, filter array<double>")
    rows = ridge.with_arrays(samples, filters, design, "k", "t", "y")
    options = {"kind": "circular", "count": 9, "least": 4}
    same = lambda df: sorted(map(tuple, df.collect()))
    got = same(ridge.with_arrays(samples, filters, design, "k", "t", "y", then=nulls.correlating("k", "bigint", **options)))
    assert got and repr(got) == repr(same(nulls.null_correlations(rows, "k", "y", "predicted", **options)))
    z = ridge.standardised(design, "t")
    got = same(ridge.with_arrays(samples, filters, design, "k", "t", "y", then=nulls.filtering(spark, z, "k", "bigint", 2.0, count=5)))
    assert got and got == same(nulls.null_filters(rows, z, "k", "y", 2.0, count=5))
