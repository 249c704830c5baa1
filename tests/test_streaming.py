"""Blocks of streams: restarts, files in pieces, late, null and repeated samples, against blocks of the sorted table."""

import datetime as dt
import random

import pytest

from tracelake.streaming import blocks, windows

SCHEMA = "k string, ts timestamp, id long, v double, block string"
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SIZE = 3
BIG = 2**60 + 1


def _stream(spark, folder, **options):
    return blocks.stream_blocks(spark.readStream.schema(SCHEMA).options(**options).parquet(folder), "k", ["id"], ["v"], SIZE, "10 seconds")


def _write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _rows(df):
    return sorted((r.k, r.block, r.place, r.ts.timestamp(), -1 if r.id is None else r.id, r.v) for r in df.collect())


def _expected(rows):
    """Blocks of the samples that the watermark has passed, from the whole table."""
    end = max(r[1] for r in rows if r[1] and r[0]) - dt.timedelta(seconds=10)
    out = []
    for k in {r[0] for r in rows if r[0]}:
        due = sorted((r for r in rows if r[0] == k and r[1] and r[1] <= end), key=lambda r: (r[1], r[2] is not None, r[2] or 0))
        out += [(k, i // SIZE, i % SIZE, r[1].timestamp(), -1 if r[2] is None else r[2], r[3]) for i, r in enumerate(due[: len(due) // SIZE * SIZE])]
    return sorted(out)


def _samples(seconds, seed):
    """Samples of three keys out of order by up to four seconds, some at the same time, some values and ids null."""
    rng = random.Random(seed)
    out = []
    for s in seconds:
        for k, n in (("a", 2), ("b", 1), ("c", rng.randint(0, 1))):
            out += [(k, START + dt.timedelta(seconds=s + rng.randint(0, 4)), BIG + 1000 * s + i, None if rng.random() < 0.2 else float(s + i), "other") for i in range(n)]
    return out


def test_a_restart_in_mid_stream_gives_the_rows_of_one_run(spark, tmp_path):
    parts = [_samples(range(10 * i, 10 * i + 10), i) for i in range(3)]
    base, folder = str(tmp_path / "base"), str(tmp_path / "in")
    for part in parts:
        _write(spark, folder, part)
        got = _rows(windows.drained(_stream(spark, folder), base))
    every = [r for part in parts for r in part]
    assert got == _expected(every) and got
    once = str(tmp_path / "once")
    _write(spark, once, every)
    assert _rows(windows.drained(_stream(spark, once))) == got
    # A restart with nothing new adds nothing.
    assert _rows(windows.drained(_stream(spark, folder), base)) == got


def test_files_one_by_one_and_samples_without_key_time_or_id(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = _samples(range(20), 7)
    rows += [(None, START, 1, 1.0, None), ("a", None, 1, 1.0, None), ("a", START, None, 1.0, None), rows[0], rows[0]]
    rows.sort(key=lambda r: (r[1] or START, r[2] or 0))
    for i in range(0, len(rows), 12):
        _write(spark, folder, rows[i : i + 12])
    got = _rows(windows.drained(_stream(spark, folder, maxFilesPerTrigger=1)))
    assert got == _expected(rows) and got


def test_an_empty_stream_has_no_blocks(spark, tmp_path):
    _write(spark, str(tmp_path), [])
    assert windows.drained(_stream(spark, str(tmp_path))).collect() == []


def test_a_window_has_the_percentile_of_its_values(spark, tmp_path):
    _write(spark, str(tmp_path), [("a", START + dt.timedelta(seconds=s), s, None if s == 3 else float(s), None) for s in range(60)])
    stream = windows.stream_percentiles(spark.readStream.schema(SCHEMA).parquet(str(tmp_path)), "k", "v", 0.5, "20 seconds", "10 seconds", "5 seconds")
    got = {int(r.window_start.timestamp() - START.timestamp()): (r.n, r.low) for r in windows.drained(stream).collect()}
    assert got == {-10: (9, pytest.approx(5.0)), 0: (19, pytest.approx(10.0)), 10: (20, pytest.approx(19.5)), 20: (20, pytest.approx(29.5)), 30: (20, pytest.approx(39.5))}


def test_many_keys_share_few_states(spark, tmp_path, monkeypatch):
    """A state for each key, and calls for each, took most of the time; keys of one place keep their own blocks, and a NaN isn't null."""
    monkeypatch.setattr(blocks, "PLACES", 16, raising=False)
    folder = str(tmp_path / "in")
    rows = [(f"k{i % 1500}", START + dt.timedelta(seconds=i // 1500), BIG + i, float(i), None) for i in range(1500 * 7)]
    rows += [("end", START + dt.timedelta(seconds=60), None, None, None), ("k7", START, BIG - 1, float("nan"), None)]
    _write(spark, folder, rows)
    before = spark.conf.get(blocks.STORE[0])
    spark.conf.set(*blocks.STORE)
    query = _stream(spark, folder).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
    spark.conf.set(blocks.STORE[0], before)
    query.awaitTermination()
    # Before, one or more for each of 1,501 keys.
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) < 200
    got = spark.read.parquet(str(tmp_path / "out")).where("k <> 'k7'")
    assert _rows(got) == _expected([r for r in rows if r[0] != "k7"])
    own = spark.read.parquet(str(tmp_path / "out")).where("k = 'k7'").orderBy("block", "place").collect()
    assert len(own) == 6 and own[0].id == BIG - 1 and own[0].v != own[0].v
