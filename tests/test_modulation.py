"""Ridge models, null distributions, linkage, registration, peaks, meshes and spectra, on small inputs and by brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.operators import graphs, linkage, meshes, nulls, peaks, registration, ridge, spectra, stats
from tracelake.plans import catalogue

SF = "/root/testdata/sf0.001"


def test_ridge_equals_a_fit_on_whole_series(spark):
    """Filters, held-out fit and what a group adds, against the same on the whole matrices; a dependent and a constant regressor count for nothing."""
    rng, n, folds = np.random.default_rng(1), 240, 4
    a, b = rng.poisson(1.0, n).astype(float), rng.normal(size=n)
    design = spark.createDataFrame([(i, i * folds // n, float(a[i]), float(b[i])) for i in range(n)], "t long, fold int, a double, b double")
    lagged = ridge.lagged(design, "t", ["a", "b"], range(3))
    x = np.stack([np.concatenate([np.zeros(k), v[: n - k]]) for v in (a, b) for k in range(3)], axis=1)
    assert np.allclose(np.stack([r.x for r in lagged.orderBy("t").collect()]), x)
    x = np.hstack([x, 2 * x[:, :1], np.ones((n, 1))])
    wide = spark.createDataFrame([(i, i * folds // n, [float(v) for v in x[i]]) for i in range(n)], "t long, fold int, x array<double>")
    ys = {1: 2 * x[:, 1] - x[:, 4] + rng.normal(size=n), 2: rng.normal(size=n), 3: np.zeros(n)}
    samples = spark.createDataFrame([(k, i, float(v)) for k, y in ys.items() for i, v in enumerate(y) if v or k == 3 and i < 2], "k long, t long, y double")
    got = {r.k: r for r in ridge.fitted(samples, wide, "k", "t", "y", {"a": 3, "b": 3, "c": 2}, penalty=7.0).collect()}
    z = lambda m: np.divide(m - m.mean(0), m.std(0), out=np.zeros_like(m), where=m.std(0) > 1e-9)

    def held_out(y, columns):
        r, w = [], []
        for f in range(folds):
            own = np.arange(n) * folds // n == f
            t, u = z(x[~own][:, columns]), z(x[own][:, columns])
            w.append(np.linalg.solve(t.T @ t + 7 * np.eye(len(columns)), t.T @ z(y[~own])))
            r.append(np.corrcoef(u @ w[-1], y[own])[0, 1])
        return np.array(r), np.mean(w, axis=0)

    for k in (1, 2):
        r, w = held_out(ys[k], list(range(6)))
        less = held_out(ys[k], [3, 4, 5])[0]
        assert abs(got[k].r - r.mean()) < 1e-9 and np.allclose(got[k].filter[:6], w) and got[k].filter[6:] == [0, 0] and got[k]["rank"] == 6
        # Without the first group its double takes the place of its first column.
        assert abs(got[k].unique["b"] - (r**2 - held_out(ys[k], [0, 1, 2])[0] ** 2).mean()) < 1e-9 and abs(got[k].unique["c"]) < 1e-9 and less is not None
    assert got[3].r == 0 and got[1].r > 0.8 and abs(got[2].r) < 0.3
    best = {r.k: r for r in ridge.fitted(samples, wide, "k", "t", "y", {"all": 8}).collect()}
    assert best[2].penalty > 10 * best[1].penalty and best[1].r > 0.8


def test_orders_keep_their_constraints():
    stimulus = np.array([1.0, 0] * 30)
    for number in range(300):
        order = nulls.chunked(60, 5, 4, 9, number, stimulus)
        starts = np.flatnonzero(np.diff(order, prepend=-9) != 1)
        assert sorted(order) == list(range(60)) and len(starts) == 6 and np.diff(np.append(starts, 60)).min() >= 4
        assert not np.array_equal(stimulus[order], stimulus) and np.array_equal(order, nulls.chunked(60, 5, 4, 9, number, stimulus))
        assert sorted(nulls.shuffled(7, 9, number)) == list(range(7)) and not np.array_equal(nulls.shuffled(2, 1, number), [0, 1])
    assert len({tuple(nulls.chunked(60, 5, 4, 9, i)) for i in range(300)}) > 290
    for bad in ((60, 0, 4), (60, 5, 11)):
        with pytest.raises(ValueError):
            nulls.chunked(*bad, 1, 1)
    turns = nulls.rotations(60, 10, stimulus, (-2, 2))
    assert {k for k, _ in turns} == set() and {k for k, _ in nulls.rotations(60, 10)} == set(range(10, 51)) and len(nulls.rotations(60, 10)) == 82
    assert list(nulls.rotated(4, (1, False))) == [3, 0, 1, 2] and list(nulls.rotated(4, (1, True))) == [2, 1, 0, 3]


def test_surrogates_keep_values_and_spectrum():
    rng = np.random.default_rng(2)
    x = np.cumsum(rng.normal(size=300)) ** 2
    made = nulls.surrogates(x, 3, range(20), 50)
    assert all(np.allclose(np.sort(m), np.sort(x)) for m in made) and np.array_equal(made[4], nulls.surrogates(x, 3, range(4, 5), 50)[0])
    size = lambda v: np.abs(np.fft.rfft(v - v.mean()))[1:]
    assert max(np.linalg.norm(size(m) - size(x)) / np.linalg.norm(size(x)) for m in made) < 0.1
    assert np.mean([abs(np.corrcoef(m, x)[0, 1]) for m in made]) < 0.6


def test_null_correlations(spark, tmp_path):
    rng = np.random.default_rng(3)
    y = {1: rng.normal(size=80), 2: rng.normal(size=80), 3: np.ones(80), 4: np.array([1.0, np.nan] * 40), 5: np.zeros(0)}
    p = {k: v + 0.1 for k, v in y.items()}
    rows = spark.createDataFrame([(k, y[k].tolist(), p[k].tolist()) for k in y] + [(6, None, [1.0]), (7, [1.0] * 3, [1.0, 2.0, 4.0])], "k long, y array<double>, p array<double>")
    for kind in ("chunk", "shuffle", "circular", "surrogate"):
        got = {(r.k, r.number): r.r for r in nulls.null_correlations(rows, "k", "y", "p", kind, count=25, seed=4, splits=4, batch=7).collect()}
        assert set(got) == {(k, i) for k in range(1, 8) for i in range(25)} and all(got[k, i] is None for k in range(3, 8) for i in range(25))
        for i in range(25):
            made = y[1][nulls._order(kind, 80, 4, i, 4, 3, None)] if kind != "surrogate" else nulls.surrogates(y[1], 4, range(i, i + 1))[0]
            assert abs(got[1, i] - np.corrcoef(made, p[1])[0, 1]) < 1e-9
    one = {(r.k, r.number): r.r for r in nulls.resumed(rows, str(tmp_path / "n"), "k", "y", "p", 20, step=10, seed=4).collect()}
    more = {(r.k, r.number): r.r for r in nulls.resumed(rows.where("k = 1"), str(tmp_path / "n"), "k", "y", "p", 30, step=10, seed=4).collect()}
    assert all(more[x] == one[x] for x in one) and set(more) - set(one) == {(1, i) for i in range(20, 30)}
    assert nulls.null_correlations(rows.where("false"), "k", "y", "p").collect() == []


def test_refits_on_shuffles(spark):
    rng = np.random.default_rng(5)
    z, y = rng.normal(size=(50, 3)), rng.normal(size=50)
    rows = spark.createDataFrame([(1, y.tolist()), (2, [1.0] * 50), (3, None)], "k long, y array<double>")
    got = nulls.null_filters(rows, z, "k", "y", 2.0, count=30, seed=6).orderBy("k", "i").collect()
    w = np.stack([np.linalg.solve(z.T @ z + 2 * np.eye(3), z.T @ ((y - y.mean()) / y.std())[nulls.shuffled(50, 6, i)]) for i in range(30)])
    assert np.allclose([[r["mean"], r["median"], r["sd"]] for r in got], np.stack([w.mean(0), np.median(w, 0), w.std(0, ddof=1)], 1))


@pytest.mark.parametrize("together", [linkage.TOGETHER, 10])
def test_linkage(spark, monkeypatch, together):
    """Against merging the nearest pair of all, one at a time; in one place and by rounds."""
    monkeypatch.setattr(linkage, "TOGETHER", together)
    rng = np.random.default_rng(7)
    data = [(f, 100 * g + i, rng.normal(size=12).tolist()) for g, (f, n) in enumerate((("a", 23), ("b", 9), ("c", 1), ("d", 2))) for i in range(n)]
    df = spark.createDataFrame(data, "f string, k long, v array<double>").repartition(5)
    leaves, merges = linkage.linked(df, "f", "k", linkage.distances(df, "f", "k", "v"))
    got = {(r.f, r.a, r.b): r.height for r in merges.collect()}
    place = {(r.f, r.k): r.place for r in leaves.collect()}
    three = {(r.f, r.k): r.cluster for r in linkage.clusters(leaves, merges, "f", "k", count=3).collect()}
    low = {(r.f, r.k): r.cluster for r in linkage.clusters(leaves, merges, "f", "k", height=0.7).collect()}
    want, seen = {}, 0
    for f in "abcd":
        v = {k: np.array(x) for g, k, x in data if g == f}
        now = {k: [k] for k in v}

        def far(x, y):
            return max(1 - np.corrcoef(v[i], v[j])[0, 1] for i in now[x] for j in now[y])

        cuts = {}
        for _ in range(len(v) - 1):
            d, x, y = min((far(x, y), x, y) for x in now for y in now if x < y)
            if d > 0.7:
                cuts.setdefault("low", list(now.values()))
            if len(now) == 3:
                cuts["three"] = list(now.values())
            want[f, x, y] = d
            now = {k: o + (now[y] if k == x else []) for k, o in now.items() if k != y}
        cuts.setdefault("low", list(now.values()))
        cuts.setdefault("three", [[k] for k in v] if len(v) < 3 else list(now.values()))
        order = next(iter(now.values()))
        assert [place[f, k] for k in order] == list(range(len(order)))
        for name, found in (("three", three), ("low", low)):
            assert sorted(sorted(k for k in order if found[f, k] == c) for c in {found[f, k] for k in order}) == sorted(map(sorted, cuts[name]))
            assert [found[f, k] for k in order] == sorted(found[f, k] for k in order) and found[f, order[0]] == 1
            seen += 1
    assert set(got) == set(want) and all(abs(got[m] - want[m]) < 1e-9 for m in want) and seen == 8


def test_registration_finds_planted_shifts(spark):
    rng = np.random.default_rng(8)
    big = np.kron(rng.normal(size=(12, 14)), np.ones((4, 4)))
    base = sum(np.roll(big, (i, j), (0, 1)) for i in range(4) for j in range(4))
    moves = [(0, 0), (3, -2), (-5, 7), (10, 1)]
    rows = [(1, i, np.roll(base, m, (0, 1)).ravel().tolist()) for i, m in enumerate(moves)] + [(1, 9, [1.0, 2.0]), (1, 10, None), (2, 11, [0.0] * base.size)]
    spectrum = np.fft.fft2(base) * np.exp(-2j * np.pi * (np.fft.fftfreq(48)[:, None] * 1.5 + np.fft.fftfreq(56)[None] * -0.5))
    rows.append((1, 20, np.fft.ifft2(spectrum).real.ravel().tolist()))
    df = spark.createDataFrame(rows, "k long, f long, v array<double>")
    target = spark.createDataFrame([(1, base.ravel().tolist()), (2, base.ravel().tolist())], "k long, template array<double>")
    got = {r.f: (r.dy, r.dx) for r in registration.offsets(df, target, "k", "f", "v", 48, 56).collect()}
    assert all(abs(got[i][0] - m[0]) < 0.1 and abs(got[i][1] - m[1]) < 0.1 for i, m in enumerate(moves))
    assert abs(got[20][0] - 1.5) < 0.6 and abs(got[20][1] + 0.5) < 0.6 and got[9] == (None, None) == got[10] and got[11] == (0, 0)
    near = {r.f: (r.dy, r.dx) for r in registration.offsets(df, target, "k", "f", "v", 48, 56, most=4).collect()}
    assert abs(near[1][0] - 3) < 0.1 and max(abs(x) for x in near[3]) <= 4.5
    back = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0, 6.0],)], "v array<double>").select(registration.moved(F.col("v"), 2, 3, F.lit(1), F.lit(-1)).alias("m")).first().m
    assert back == [None, 4, 5, None, None, None]
    mean = registration.template(spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 6.0])], "k long, v array<double>"), "k", "v").first().template
    assert mean == [2.0, 4.0]


def test_peaks_by_brute_force(spark):
    rng = np.random.default_rng(9)
    traces = {"a": rng.integers(0, 30, 400), "b": rng.integers(0, 4, 300), "c": np.arange(50)}
    rows = [(k, t, float(v)) for k, x in traces.items() for t, v in enumerate(x) if not (k == "a" and 100 <= t < 104)] + [("d", 1, None)]
    df = spark.createDataFrame(rows, "k string, t long, v double").repartition(4)
    got = {(r.k, r.t) for r in peaks.peaks(df, "k", "t", "v", F.lit(2.0), 6).collect()}
    value, want = {(k, t): v for k, t, v in rows if v is not None}, set()
    for key in "abc":
        found = [t for k, t in value if k == key and (k, t - 1) in value and (k, t + 1) in value and value[k, t - 1] < value[k, t] >= value[k, t + 1] and value[k, t] >= 2]
        kept = []
        for t in sorted(found, key=lambda t: (-value[key, t], t)):
            if all(abs(t - u) > 6 for u in kept):
                kept.append(t)
        want |= {(key, t) for t in kept}
    assert got == want and len(want) > 60 and peaks.peaks(df.where("false"), "k", "t", "v", F.lit(2.0), 6).collect() == []
    starts = spark.createDataFrame([("a", t) for t in (0, 10, 20, 30, 60)], "k string, t long")
    ends = spark.createDataFrame([("a", t) for t in (8, 18, 29, 38, 39)], "k string, t long")
    assert [tuple(r) for r in peaks.frames(starts, ends, "k", "t").orderBy("start").collect()] == [("a", 0, 8, False), ("a", 10, 18, False), ("a", 20, 29, True), ("a", 30, 38, False)]


def test_points_inside_meshes(spark):
    """Boxes and a tetrahedron; rays through edges and corners, points with missing coordinates and of no mesh."""
    def box(name, low, high):
        c = np.array([[(low, high)[i >> k & 1][k] for k in range(3)] for i in range(8)], float)
        quads = [(0, 1, 3, 2), (4, 6, 7, 5), (0, 4, 5, 1), (2, 3, 7, 6), (0, 2, 6, 4), (1, 5, 7, 3)]
        return [(name, *map(float, c[[a, b, d]].ravel())) for q in quads for a, b, d in ((q[0], q[1], q[2]), (q[0], q[2], q[3]))]

    mesh = spark.createDataFrame(box("m", (0, 0, 0), (2, 3, 1)) + box("m", (5, 0, 0), (6, 1, 1)) + box("o", (-1, -1, -1), (1, 1, 1)), "mesh string, " + ", ".join(f"{a}{i} double" for i in (1, 2, 3) for a in "xyz"))
    grid = [(x, y, z) for x in np.arange(-1.75, 7, 0.5) for y in np.arange(-1.5, 4, 0.5) for z in np.arange(-1.5, 2, 0.5)]
    rows = [(m, i, *map(float, p)) for m in ("m", "o", "none") for i, p in enumerate(grid)] + [("m", 9999, None, 0.5, 0.5)]
    got = {(r.mesh, r.k): r.inside for r in meshes.inside(spark.createDataFrame(rows, "mesh string, k long, x double, y double, z double"), mesh, "mesh", "k", 0.7).collect()}
    in_box = lambda p, low, high: all(a <= v < b for v, a, b in zip(p, low, high))
    for i, p in enumerate(grid):
        assert got["m", i] == (in_box(p, (0, 0, 0), (2, 3, 1)) or in_box(p, (5, 0, 0), (6, 1, 1))) and got["o", i] == in_box(p, (-1, -1, -1), (1, 1, 1)) and not got["none", i]
    assert not got["m", 9999] and len(got) == len(rows)


def test_spectra_of_planted_frequencies(spark):
    t = np.arange(256)
    rng = np.random.default_rng(10)
    rows = [(i, (np.sin(2 * np.pi * t * (3 if i < 5 else 13) / 32) + 0.1 * rng.normal(size=256)).tolist()) for i in range(10)] + [(20, [1.0] * 8), (21, None), (22, [0.0] * 256)]
    found = spectra.spectra(spark.createDataFrame(rows, "k long, v array<double>"), "k", "v", 32)
    power = {r.k: r.power for r in found.collect()}
    assert all(int(np.argmax(power[i])) == (3 if i < 5 else 13) for i in range(10)) and power[20] is None and power[21] is None
    assert np.allclose(power[0], spectra.periodogram(np.array(rows[0][1]), 32))
    assert {r.k: r.active for r in spectra.classes(found, "k", 8).collect()} == {i: i < 5 for i in range(10)} | {20: None, 21: None, 22: None}
    floor = found.where("k = 0").select(spectra.above_as_floor("power", 8).alias("p")).first().p
    assert floor[:8] == power[0][:8] and np.allclose(floor[8:], np.exp(np.mean(np.log(power[0][8:]))))


def test_numbers_over_ranges(spark):
    df = spark.range(100).select((97 * F.col("id") % 101).alias("a"), F.when(F.col("id") != 5, F.col("id")).alias("b"))
    rows = sorted(stats.numbered(df, ["a", "b"], "n").collect(), key=lambda r: r.n)
    assert [r.n for r in rows] == list(range(1, 101)) and [r.a for r in rows] == sorted(r.a for r in rows)
    assert stats.numbered(df.where("false"), ["a"], "n").collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 20, 64, 80, 100])
def test_chains_of_any_length(spark, n):
    chain = [(i, i - 1 if i else None) for i in range(n)] + [(1000, 1001), (1001, 1000), (1002, 5000)]
    df = spark.createDataFrame(chain, "node long, parent long")
    assert sorted((r.node, r.root, r.depth) for r in graphs.depths(df).collect()) == [(i, 0, i) for i in range(n)]
    if n in (1, 20, 80):
        assert sorted((r.node, r.depth, len(r.path)) for r in graphs.root_paths(df).collect()) == [(i, i, i + 1) for i in range(n)]
        assert [tuple(r) for r in graphs.longest_paths(df).collect()] == [(0, n - 1, list(range(n)))]


@pytest.mark.parametrize("name", ["stim_ridge", "ridge_null", "hclust", "phase_corr", "spectral_classes", "shuffled_filters"])
def test_queries_give_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0
