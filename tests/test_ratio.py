"""Two-channel segmentation against a brute-force version, with missing values, constant images and empty tables."""

import numpy as np
from pyspark.sql import functions as F

from tracelake.operators import ratio

PIXELS = "k string, y int, x int, p double, q double"


def _sd(v):
    return np.nan if not len(v) else 0.0 if len(v) == 1 else np.std(v, ddof=1)


def _scores(rows):
    rows = [r for r in rows if None not in r and not np.isnan(r[3]) and not np.isnan(r[4]) and r[3] > 25]
    out = {}
    for k in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == k]
        u, v = (np.array([r[i] for r in own]) for i in (3, 4))
        u, v = (u - u.min()) / u.max(), (v - v.min()) / v.max()
        some = (u > 0.005) & (v > 0.005)
        own, u, v = [r for r, s in zip(own, some) if s], u[some], v[some]
        inside = np.ones(len(u), bool)
        for i in range(16):
            m, b = np.polyfit(u[inside & (v >= 1 - 0.7 - i * 0.02)], v[inside & (v >= 1 - 0.7 - i * 0.02)], 1)
            res = m * u + b - v
            inside = ~(res > 3 * _sd(res[res < 0]))
        m, b = np.polyfit(u[inside], v[inside], 1)
        res = m * u + b - v
        below = _sd(res[inside][res[inside] < 0])
        out |= {(k, r[1], r[2]): s / below for r, s in zip(own, res)}
    return out


def _components(pixels, least):
    left, out = set(pixels), set()
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            y, x = todo.pop()
            group.add((y, x))
            near = {(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)} & left
            left -= near
            todo += near
        out |= group if len(group) >= least else set()
    return out


def _mask(score, domain, threshold, least, last):
    out = set()
    for k in {c[0] for c in score}:
        own = {c[1:]: s for c, s in score.items() if c[0] == k}
        whole = _components([c for c, s in own.items() if s > 0], least)
        above = {c for c in whole if own[c] > threshold}
        dense = {(y, x) for g, y, x in domain if g == k and sum((y + a, x + b) in above for a in (-1, 0, 1) for b in (-1, 0, 1)) >= 5}
        out |= {(k, *c) for c in _components(dense, last)}
    return out


def _image():
    rng, rows = np.random.default_rng(3), []
    for k in "ab":
        for y in range(24):
            for x in range(24):
                q = rng.uniform(30, 300)
                low = 60 if (y - 12) ** 2 + (x - 9) ** 2 < 30 else 0
                rows.append((k, y, x, float(q), float(1.5 * q + 200 - 1.5 * low + rng.normal(0, 12))))
    rows[5], rows[17], rows[40] = (*rows[5][:3], None, 3.0), (*rows[17][:3], float("nan"), 3.0), (*rows[40][:3], 40.0, None)
    rows[60] = (*rows[60][:3], 20.0, 500.0)
    return rows


def test_scores_and_mask_are_those_of_brute_force(spark):
    rows = _image()
    df = spark.createDataFrame(rows, PIXELS)
    scored = ratio.scores(df, "k", "p", "q")
    want = _scores(rows)
    got = {(r.k, r.y, r.x): r.score for r in scored.collect()}
    assert got.keys() == want.keys() and all(abs(got[c] - want[c]) < 1e-6 for c in got)
    for threshold, least, last in ((1.0, 10, 10), (0.2, 4, 1)):
        found = {tuple(r) for r in ratio.mask(scored, df, "k", threshold, 3, least, last).collect()}
        assert found == _mask(want, [r[:3] for r in rows], threshold, least, last)
        assert threshold == 0.2 or {("a", 12, 9), ("b", 12, 9)} <= found


def test_images_without_a_line(spark):
    rows = [("flat", 0, i, 50.0, 10.0 + i) for i in range(5)] + [("one", 0, 0, 80.0, 9.0), ("dim", 0, 0, 3.0, 9.0), (None, 0, 0, 90.0, 9.0)]
    df = spark.createDataFrame(rows, PIXELS)
    assert ratio.scores(df, "k", "p", "q").where(F.col("score").isNotNull()).collect() == []
    empty = df.where("false")
    assert ratio.scores(empty, "k", "p", "q").collect() == []
    assert ratio.mask(ratio.scores(empty, "k", "p", "q"), empty, "k").collect() == []
