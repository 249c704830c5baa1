"""Linkage of series in blocks: nearest pairs, leaves and merges are those of the distances as rows."""

import numpy as np
import pytest

from tracelake.operators import linkage


@pytest.mark.parametrize("values, together", [(linkage.VALUES, linkage.TOGETHER), (200, 100)])
def test_blocks_give_what_rows_give(spark, monkeypatch, values, together):
    monkeypatch.setattr(linkage, "VALUES", values)
    monkeypatch.setattr(linkage, "TILE", 7)
    monkeypatch.setattr(linkage, "TOGETHER", together)
    rng = np.random.default_rng(4)
    rows = [(f, int(k), rng.normal(size=8).tolist()) for f, n in ((1, 40), (2, 23), (3, 1), (4, 2)) for k in rng.permutation(1000)[:n]]
    rows += [(1, 2000 + i, rows[i][2]) for i in range(5)] + [(2, 2000, [1.0] * 8), (2, 2001, [None, float("nan")] + [0.5, 2.0] * 3)]
    df = spark.createDataFrame(rows, "f int, k long, v array<double>")
    d = linkage.distances(df, "f", "k", "v")
    pairs = lambda x: {(r.f, r.a, r.b): r.height for r in x.collect()}
    assert pairs(linkage.reciprocal_series(df, "f", "k", "v")) == pytest.approx(pairs(linkage.reciprocal(d, "f")), abs=1e-11)
    got, want = linkage.linked_series(df, "f", "k", "v"), linkage.linked(df, "f", "k", d)
    assert {tuple(r) for r in got[0].collect()} == {tuple(r) for r in want[0].collect()}
    tree = [{(r.f, r.a, r.b, r["round"]): r.height for r in x[1].collect()} for x in (got, want)]
    assert tree[0] == pytest.approx(tree[1], abs=1e-11) and len(tree[0]) == len(rows) - 4


def test_large_families_make_few_rows(spark):
    """8,000 series are 32 million pairs: of distances as rows, more than a test has time for."""
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(0, k, rng.normal(size=16).tolist()) for k in range(8000)], "f int, k long, v array<double>")
    assert linkage._made(linkage._points(df, "f", "k", "v"), "f", False, False).count() <= 16000
    x = np.array([r.v for r in df.orderBy("k").collect()])
    r = np.corrcoef(x[:50], x)[:50, 50:]
    r[np.arange(50), np.arange(50)] = -2
    near = {int(e): (int(a), int(b)) for e, a, b in linkage._made(linkage._points(df, "f", "k", "v"), "f", False, False).where("end < 50").select("end", "a", "b").collect()}
    assert all(near[i] == (min(i, j), max(i, j)) for i, j in enumerate(map(int, r.argmax(axis=1))))
