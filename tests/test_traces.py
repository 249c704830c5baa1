"""Traces of components against dense matrices, with overlaps, absent frames, repeated and null rows and empty tables."""

import numpy as np
import pytest

from tracelake.operators import traces

MOVIE, WEIGHTS, SERIES = "r string, pixel long, t long, v double", "r string, comp long, pixel long, w double", "r string, comp long, t long, v double"
K, B, P, T, HALF = 4, 2, 30, 40, 5


def _tables(seed):
    rng = np.random.default_rng(seed)
    a = np.zeros((K, P))
    for k in range(K):
        a[k, 6 * k : 6 * k + 9] = rng.random(9) + 0.1
    return a, rng.random((B, P)) + 0.5, rng.random((K, T)) * 3, rng.random((B, T)) + 1, rng.random((P, T)) * 5


def _support(w, share):
    out = np.zeros_like(w)
    for k, row in enumerate(w):
        left = share * (row**2).sum()
        for p in sorted(range(P), key=lambda p: (-abs(row[p]), p)):
            if left <= 1e-12 or not row[p]:
                break
            out[k, p], left = 1, left - row[p] ** 2
    return out / np.sqrt(out.sum(1, keepdims=True))


def _running(x, p):
    return np.array([[np.percentile(r[max(0, i - HALF) : i + HALF + 1], 100 * p) for i in range(len(r))] for r in x])


def _dense(a, b, c, f, y, share, base):
    na, nb = np.sqrt((a**2).sum(1)), np.sqrt((b**2).sum(1))
    a, b, c, f = a / na[:, None], b / nb[:, None], c * na[:, None], f * nb[:, None]
    yf = a @ y - a @ a.T @ c
    yr = yf - a @ b.T @ f + c
    u = _support(a, share)
    back = u @ b.T @ f
    raw = u @ y - back
    level = lambda x: x if base is None else np.percentile(x, 100 * base, axis=1, keepdims=True)
    out = {}
    for name, x, bg in (("inferred", c, yf), ("filtered", yr, yf - yr + c), ("raw", raw, back)):
        trend = _running(x, 0.2)
        out |= {f"{name}_trend": trend, f"{name}_df": x - trend, f"{name}_f": level(bg) + trend, f"{name}_dfof": (x - trend) / (level(bg) + trend)}
    return out


def _long(spark, schema, **tables):
    rows = [(r, *map(int, i), float(v)) for r, m in tables.items() for i, v in np.ndenumerate(m) if v]
    return spark.createDataFrame(rows, schema)


def _frames(spark, one, two):
    made = lambda schema, i: _long(spark, schema, one=one[i], two=two[i])
    return made(MOVIE, 4), made(WEIGHTS, 0), made(SERIES, 2), made(WEIGHTS, 1), made(SERIES, 3)


@pytest.mark.parametrize("share, base", [(0.8, None), (1.0, 0.1)])
def test_traces_are_those_of_dense_matrices(spark, share, base):
    one, two = _tables(1), _tables(2)
    got = traces.extracted(traces.unmixed(*_frames(spark, one, two), ["r"], share), ["r"], 0.2, HALF, base).collect()
    assert len(got) == 2 * K * T
    want = {"one": _dense(*one, share, base), "two": _dense(*two, share, base)}
    for row in got:
        for name, values in want[row.r].items():
            assert row[name] == pytest.approx(values[row.comp, row.t], rel=1e-9, abs=1e-9), name


def test_a_planted_trace_comes_back(spark):
    """Where the movie is just components and background, nothing is left over."""
    a, b, c, f, _ = _tables(3)
    y = a.T @ c + b.T @ f
    rows = traces.unmixed(*_frames(spark, (a, b, c, f, y), (a, b, c, f, y)), ["r"]).where("r = 'one'").collect()
    norm = np.sqrt((a**2).sum(1))
    assert all(abs(r.yr - c[r.comp, r.t] * norm[r.comp]) < 1e-9 and abs(r.c - c[r.comp, r.t] * norm[r.comp]) < 1e-9 for r in rows)


def test_absent_frames_null_and_repeated_rows_and_nothing_at_all(spark):
    movie = spark.createDataFrame([("x", 0, 0, 1.0), ("x", 0, 0, 1.0), ("x", 0, 1, None), ("x", 9, 5, 3.0), (None, 0, 0, 1.0)], MOVIE)
    spatial = spark.createDataFrame([("x", 0, 0, 1.5), ("x", 0, 0, 0.5), ("x", 1, 0, None), ("x", 2, 3, 0.0)], WEIGHTS)
    temporal = spark.createDataFrame([("x", 0, 0, 1.0), ("x", 0, 2, float("nan")), ("x", 7, 0, 1.0)], SERIES)
    empty = [spark.createDataFrame([], s) for s in (WEIGHTS, SERIES)]
    parts = traces.unmixed(movie, spatial, temporal, *empty, ["r"])
    got = sorted((r.comp, r.t, r.c, r.yf, r.yr, r.raw) for r in parts.collect())
    # The weight is 1 after scaling by 2; frame 0 holds 2, of which the series accounts for 2; frame 2 isn't in the movie.
    assert got == [(0, 0, 2.0, 0.0, 2.0, 2.0), (0, 1, 0.0, 0.0, 0.0, 0.0), (0, 2, 0.0, None, None, None)]
    made = {r.t: r for r in traces.extracted(parts, ["r"], half=1).collect()}
    assert made[2].raw_df is None and made[2].filtered_dfof is None and made[0].inferred_dfof is not None
    assert traces.extracted(traces.unmixed(movie.where("false"), spatial.where("false"), temporal.where("false"), *empty, ["r"]), ["r"]).collect() == []
