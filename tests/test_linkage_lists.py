"""Linkage of series by lists of nearest clusters: the tree is that of the distances as rows, in few passes."""

import numpy as np
import pytest

from tracelake.operators import linkage


@pytest.mark.parametrize("held, listed, entries", [(1 << 22, 4, 1 << 20), (40, 9, 1 << 20), (1 << 22, 64, 3)])
def test_lists_give_what_rows_give(spark, monkeypatch, held, listed, entries):
    for name, value in (("VALUES", 300), ("TILE", 7), ("CLUSTERS", 5), ("HELD", held), ("LISTED", listed), ("ENTRIES", entries), ("LEVELS", 2)):
        monkeypatch.setattr(linkage, name, value)
    rng = np.random.default_rng(6)
    rows = [(f, int(k), (0.05 * rng.normal(size=8) + [k % 7 == j for j in range(8)]).tolist()) for f, n in ((1, 60), (2, 23), (3, 1), (4, 2)) for k in rng.permutation(1000)[:n]]
    # Copies, constant series (as far from all) and series with equal distances.
    rows += [(1, 2000 + i, rows[i // 2][2]) for i in range(8)] + [(2, 2000 + i, [1.0] * 8) for i in range(4)] + [(5, i, [float(i == j) for j in range(8)]) for i in range(8)]
    df = spark.createDataFrame([*rows, (None, 1, [0.0] * 8)], "f int, k long, v array<double>")
    got, want = linkage.linked_series(df, "f", "k", "v"), linkage.linked(df, "f", "k", linkage.distances(df, "f", "k", "v"))
    assert {tuple(r) for r in got[0].collect()} == {tuple(r) for r in want[0].collect()}
    tree = [{(r.f, r.a, r.b): r.height for r in x[1].collect()} for x in (got, want)]
    assert tree[0] == pytest.approx(tree[1], abs=1e-11) and len(tree[0]) == len(rows) - 5


def test_large_families_take_few_passes(spark, monkeypatch):
    """3,000 series in loose groups are merged within four passes over their distances."""
    passes, plain = [], linkage._blocks
    monkeypatch.setattr(linkage, "_blocks", lambda *a: passes.append(a) or plain(*a))
    rng = np.random.default_rng(7)
    middle = rng.normal(size=(800, 32))
    df = spark.createDataFrame([(0, k, (middle[k % 800] + 0.3 * rng.normal(size=32)).tolist()) for k in range(3000)], "f int, k long, v array<double>")
    leaves, merges = linkage.linked_series(df, "f", "k", "v")
    assert merges.count() == 2999 and len({r.place for r in leaves.collect()}) == 3000
    assert len(passes) <= 4, len(passes)
