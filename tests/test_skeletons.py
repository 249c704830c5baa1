"""Skeletons from text: comments, faults and round trips; smoothing against numpy; runs of nodes in one place."""

import numpy as np
import pytest

from tracelake.operators import skeletons as ops
from tracelake.sources import skeletons

NODES = "tree string, node long, kind int, x double, y double, z double, radius double, parent long"


def test_reading_leaves_out_what_is_not_a_tree(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    files = {
        "good.swc": "# made by hand\n1 1 0 0 0 1 -1\n\n 2\t3 1.5 0 0 0.5 1 # end\n3 3 2 0 0 .5 2 extra\n",
        "deep/a+l so.good.swc": "5 1 0 0 0 1 -1\n",
        "short.swc": "1 1 0 0 0 1 -1\n2 3 1 0 0 1\n",
        "letters.swc": "1 1 0 0 0 1 -1\n2 3 a 0 0 1 1\n",
        "twice.swc": "1 1 0 0 0 1 -1\n1 3 0 0 0 1 1\n",
        "lost.swc": "1 1 0 0 0 1 -1\n2 3 0 0 0 1 9\n",
        "forest.swc": "1 1 0 0 0 1 -1\n2 3 0 0 0 1 -1\n",
        "circle.swc": "1 1 0 0 0 1 2\n2 3 0 0 0 1 1\n",
        "empty.swc": "# nothing\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    got = sorted((r.tree, r.node, r.x, r.parent) for r in skeletons.skeletons(spark, str(tmp_path)).collect())
    assert got == [("a+l so.good", 5, 0.0, None), ("good", 1, 0.0, None), ("good", 2, 1.5, 1), ("good", 3, 2.0, 2)]
    why = {r.tree: (r.n_lines, r.why) for r in skeletons.rejected(spark, str(tmp_path)).collect()}
    assert why == {"short": (2, "line"), "letters": (2, "line"), "twice": (2, "repeated node"), "lost": (2, "unknown parent"), "forest": (2, "roots"), "circle": (2, "roots")}


def test_what_is_written_is_read_again(spark, tmp_path):
    rows = [(t, i, 3, i / 3, -i / 7, 1e-9 * i, 0.1, i // 2 if i > 1 else None) for t in ("a b", "c=d", "ü", "x+y/z", "50%41") for i in range(1, 20)]
    skeletons.write_skeletons(spark.createDataFrame(rows, NODES), str(tmp_path / "out"))
    got = sorted(map(tuple, skeletons.skeletons(spark, str(tmp_path / "out")).collect()))
    assert got == sorted(rows)


def test_a_table_as_text_with_a_header(spark, tmp_path):
    skeletons.write_table(spark.createDataFrame([("a", 1.5), (None, 2.0)], "k string, v double").coalesce(1), str(tmp_path / "t"))
    (part,) = (tmp_path / "t").glob("part-*")
    assert part.read_text().splitlines() == ["k\tv", "a\t1.5", "\t2.0"]


@pytest.mark.parametrize("span, n", [(5, 12), (6, 12), (5, 3), (1, 4), (7, 1)])
def test_smoothing_shrinks_evenly_at_the_ends(spark, span, n):
    v = np.random.default_rng(n).normal(size=(n, 3))
    rows = [("a", i, 3, *map(float, v[i]), 1.0, None) for i in range(n)]
    half = (span - 1) // 2
    got = {r.node: (r.x_s, r.y_pix) for r in ops.in_pixels(ops.smoothed(spark.createDataFrame(rows, NODES), span), {"y": 0.5}, "smooth").collect()}
    for i in range(n):
        k = min(half, i, n - 1 - i)
        want = v[i - k : i + k + 1].mean(0)
        assert got[i] == pytest.approx((want[0], want[1] / 0.5))


def test_runs_of_nodes_in_one_place_collapse(spark):
    n = 40
    chain = [("a", i, 3, float(i // 20), 0.0, 0.0, 1.0, i - 1 if i else None) for i in range(n)]
    branch = [("a", 100, 3, 5.0, 0.0, 0.0, 1.0, 17), ("a", 101, 3, 5.0, 0.0, 0.0, 1.0, 39), ("b", 1, 3, 0.0, 0.0, 0.0, 1.0, None), ("b", 2, 3, None, 0.0, 0.0, 1.0, 1)]
    got = sorted((r.tree, r.node, -1 if r.parent is None else r.parent) for r in ops.without_zero_lengths(spark.createDataFrame(chain + branch, NODES)).collect())
    assert got == [("a", 0, -1), ("a", 20, 0), ("a", 100, 0), ("a", 101, 20), ("b", 1, -1), ("b", 2, 1)]
    assert ops.without_zero_lengths(spark.createDataFrame([], NODES)).collect() == []
    loop = [("c", 1, 3, 0.0, 0.0, 0.0, 1.0, 2), ("c", 2, 3, 0.0, 0.0, 0.0, 1.0, 1)]
    with pytest.raises(ValueError):
        ops.without_zero_lengths(spark.createDataFrame(loop, NODES))
