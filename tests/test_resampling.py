"""Resampling in space and time against numpy, with missing, absent and repeated samples and empty tables."""

import numpy as np

from tracelake.operators import resampling

VOXELS = "k string, z long, y long, x long, v double"


def _along(v, axis, old, new):
    at = np.arange(0, (v.shape[axis] - 1) * old + 1e-12, new)
    return np.apply_along_axis(lambda s: np.interp(at, np.arange(len(s)) * old, s), axis, v)


def test_space_is_separable_interpolation(spark):
    rng = np.random.default_rng(5)
    volume = rng.normal(size=(3, 6, 7))
    rows = [("a", *map(int, i), float(v)) for i, v in np.ndenumerate(volume)]
    axes = {"z": (2.0, 2.0), "y": (1.0, 0.4), "x": (0.5, 0.8)}
    got = {(r.z, r.y, r.x): r.v for r in resampling.in_space(spark.createDataFrame(rows, VOXELS), ["k"], axes, "v").collect()}
    want = dict(np.ndenumerate(_along(_along(volume, 1, 1.0, 0.4), 2, 0.5, 0.8)))
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_space_with_missing_absent_and_repeated_samples(spark):
    line = [0.0, 2.0, None, 4.0, float("nan"), 5.0, 7.0, 8.0]
    rows = [("a", 0, 0, x, v) for x, v in enumerate(line) if x != 6] + [("a", 0, 0, 1, 4.0)]
    df = spark.createDataFrame(rows, VOXELS)
    made = resampling.in_space(df, ["k"], {"z": (1.0, 1.0), "y": (1.0, 1.0), "x": (1.0, 0.5)}, "v")
    got = {r.x: r.v for r in made.collect()}
    # At 0 and 1 samples, between them, null around 2 and 4, no row where sample 6 counts.
    assert got == {0: 0.0, 1: 1.5, 2: 3.0, 3: None, 4: None, 5: None, 6: 4.0, 7: None, 8: None, 9: None, 10: 5.0, 14: 8.0}
    assert resampling.in_space(df.where("false"), ["k"], {"x": (1.0, 0.5)}, "v").collect() == []


def test_each_plane_goes_from_its_own_clock_to_the_common_one(spark):
    rng = np.random.default_rng(6)
    rows, clocks, want = [], [], {}
    for z in range(3):
        times = np.sort(rng.choice(np.arange(5, 200), 20, replace=False))
        zero = int(times[2]) if z else 0
        clocks += [(z, i, int(t)) for i, t in enumerate(times)]
        for y in range(2):
            values = rng.normal(size=20)
            rows += [("a", z, y, i, float(v)) for i, v in enumerate(values)]
            at = [g for g in range(-200, 200, 10) if times[0] - zero <= g <= times[-1] - zero]
            want |= {(z, y, g): float(np.interp(g, times - zero, values)) for g in at}
    clocks += [(0, 99, None), (0, 98, clocks[3][2])]
    made = spark.createDataFrame(clocks, "z long, x long, t long")
    stimuli = spark.createDataFrame([(1, c[2]) for c in clocks if c[:2] == (1, 2)] + [(2, c[2]) for c in clocks if c[0] == 2 and c[1] >= 2], "z long, onset long")
    weights = resampling.clock_weights(resampling.aligned(made, stimuli, "z"), ["z"], "x", 10)
    got = {(r.z, r.y, r.t): r.v for r in resampling.in_time(spark.createDataFrame(rows, VOXELS), weights, ["z"], "x", ["y"], "v").collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_a_pixel_missing_once_is_missing_throughout(spark):
    df = spark.createDataFrame([("a", 0, 0, 0, 1.0), ("a", 1, 0, 0, float("nan")), ("a", 0, 0, 1, 1.0), ("a", 1, 0, 1, 2.0), ("b", 0, 0, 0, 3.0)], VOXELS)
    got = sorted((r.k, r.z, r.x, r.v) for r in resampling.missing_throughout(df, ["k", "y", "x"], "v").collect() if r.v is not None)
    assert got == [("a", 0, 1, 1.0), ("a", 1, 1, 2.0), ("b", 0, 0, 3.0)]
