"""Sources, streams, models and geometry on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.operators import frames, graphs, models, space
from tracelake.plans import catalogue
from tracelake.sources import logs

SF = "/root/testdata/sf0.001"


def test_tracking_log(spark, tmp_path):
    (tmp_path / "a.dat").write_text(", ".join(map(str, range(1, 24))) + "\n2, x\n")
    rows = logs.tracking_log(spark, str(tmp_path)).orderBy("frame").collect()
    assert len(rows[0]) == 23 and rows[0].frame == 1 and rows[0].t == 22.0 and rows[0].sequence == 23
    assert rows[1].frame == 2 and rows[1].d_cam_x is None and rows[1].sequence is None
    assert logs.tracking_stream(spark, str(tmp_path)).isStreaming


def test_files_at_any_depth(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    for name in ("a.dat", "x/b.dat", "x/y/c.dat", "x/y/d.txt"):
        (tmp_path / name).write_text("12345")
    rows = logs.files(spark, str(tmp_path), "*.dat").collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in rows) == ["a.dat", "b.dat", "c.dat"] and {r.length for r in rows} == {5}


def test_ridge_finds_a_repeating_series_and_not_noise(spark):
    t, rng = np.arange(200), np.random.default_rng(1)
    rows = [(1, np.sin(t / 3).tolist()), (2, rng.normal(size=200).tolist()), (3, [1.0] * 50), (4, [1.0, 2.0]), (5, None)]
    got = {r.k: r.r for r in models.ridge_cv(spark.createDataFrame(rows, "k long, v array<double>"), "k", "v").collect()}
    assert got[1] > 0.99 and abs(got[2]) < 0.4 and got[3] is None and got[4] is None and got[5] is None


def test_clusters_and_mixture(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=2) + 20 * (i % 2)).tolist()) for i in range(100)]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    got = {r.k: r.cluster for r in models.clusters(df, "k", "v", 2).collect()}
    assert len({got[i] for i in range(0, 100, 2)}) == len({got[i] for i in range(1, 100, 2)}) == 1 and got[0] != got[1]
    low, high = models.mixture(df, F.col("v")[0]).orderBy("component").collect()
    assert abs(low.mean) < 1 and abs(high.mean - 20) < 1 and abs(low.weight - 0.5) < 0.05


def test_near_points_by_brute_force(spark):
    points = np.random.default_rng(3).uniform(-1, 1, (200, 2)).round(2)
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "k long, x double, y double")
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2)) + np.eye(200) * 99
    got = {r.k: (r.n_near, r.least) for r in space.near_points(df, df, 0.13, "k").collect()}
    for i in range(200):
        n = int((apart[i] <= 0.13).sum())
        assert got[i][0] == n and (got[i][1] is None if n == 0 else abs(got[i][1] - apart[i].min()) < 1e-9)


def test_root_paths(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 1), (5, 6), (6, 5)], "node long, parent long")
    got = {r.node: (r.depth, r.path) for r in graphs.root_paths(df).collect()}
    assert got == {1: (0, [1]), 2: (1, [1, 2]), 3: (2, [1, 2, 3]), 4: (1, [1, 4])}


@pytest.mark.parametrize("name", ["ridge_cv", "kmeans", "gauss_fit"])
def test_queries_give_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_rows_with_the_keys_in_their_text(spark):
    rows = spark.createDataFrame([(1, "banana"), (2, "ananas"), (2, "ananas"), (3, ""), (4, None), (5, "naïve é")], "i int, t string")
    keys = ["ana", "ana", "nanas", "é", "bananas", None, ""]
    got = sorted((r.i, r.k) for r in frames.containing(rows, "t", spark.createDataFrame([(k,) for k in keys], "k string")).collect())
    assert got == sorted({(i, k) for i, t in rows.collect() if t is not None for k in keys if k is not None and k in t})
    assert frames.containing(rows, "t", spark.createDataFrame([], "k string")).collect() == []
