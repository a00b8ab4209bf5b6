"""The compacted metric store: batches, replays, corrections, retention and newest-first reads."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from transitlens.operators.store import FAN, MetricStore
from transitlens.sources import files

SCHEMA = ("window_start timestamp, window_end timestamp, route string, direction string, window_type string, "
          "vehicle_count long, active_vehicles long, avg_speed double, avg_delay double, min_delay int, max_delay int")
BEGIN = dt.datetime(2024, 3, 1, 23, 50)


def row(second, count, route="a"):
    start = BEGIN + dt.timedelta(seconds=second)
    return (start, start + dt.timedelta(seconds=10), route, "1", "tumbling_10s", count, count, 1.0, 2.0, 0, 3)


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(store):
    return sorted((r.window_end, r.route or "", r.vehicle_count) for r in store.read().collect())


def folders(spark, root):
    return sum(len(files.names(spark, f"{root}/{part}")) for part in ("runs", "open", "manifest"))


def test_fifty_batches(spark, tmp_path):
    """Windows are emitted again for a minute; the store ends up with their last form in few folders."""
    store, want, most = MetricStore(spark, str(tmp_path)), {}, 0
    rng = random.Random(1)
    for b in range(50):
        now = 20 * b
        rows = {(s, r): row(s, 1000 * b + s, r) for r in ("a", None) for s in range(max(0, now - 40), now + 20, 10) if rng.random() < 0.6}
        want.update({(v[1], v[2]): v[5] for v in rows.values()})
        assert store.commit(batch(spark, list(rows.values())), b)
        most = max(most, folders(spark, str(tmp_path)))
        if b % 17 == 0:
            before = content(store)
            assert not store.commit(batch(spark, [row(0, -1)]), b)
            assert content(store) == before
    # Two levels of fewer than FAN runs, what the last manifests still name, open folders and manifests.
    assert most <= 4 * FAN
    got = sorted((r.window_end, r.route or "", r.vehicle_count) for r in store.read().collect())
    assert got == sorted((end, route or "", n) for (end, route), n in want.items())
    assert {r[0] for r in store.read().select("window_date").distinct().collect()} == {dt.date(2024, 3, 1), dt.date(2024, 3, 2)}
    assert store.spark.read.schema(SCHEMA).parquet(f"{tmp_path}/open/{store.manifest().open}").count() < 40


def test_crash_before_the_manifest(spark, tmp_path, monkeypatch):
    store = MetricStore(spark, str(tmp_path))
    for b in range(4):
        store.commit(batch(spark, [row(100 * b, b)]), b)
    before = content(store)
    with monkeypatch.context() as m:
        m.setattr(store, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.commit(batch(spark, [row(400, 4)]), 4)
    assert content(store) == before
    assert store.commit(batch(spark, [row(400, 4)]), 4) and len(content(store)) == 5


def test_corrections_of_closed_windows(spark, tmp_path):
    store = MetricStore(spark, str(tmp_path))
    for b in range(5):
        store.commit(batch(spark, [row(200 * b, b), row(200 * b + 10, b)]), b)
    store.commit(batch(spark, [row(0, 99), row(20, 7, None)]), 5)
    store.commit(batch(spark, [row(20, 8, None)]), 6)
    got = {r.window_start: r.vehicle_count for r in store.read().collect()}
    assert got[BEGIN] == 99 and got[BEGIN + dt.timedelta(seconds=20)] == 8 and len(got) == 11


def test_expired_files_go_and_readers_stay_whole(spark, tmp_path):
    store = MetricStore(spark, str(tmp_path))
    days = [row(86_400 * d + s, d) for d in range(5) for s in (0, 10)]
    store.load(batch(spark, days))
    reader = store.read()  # planned before the dates go
    kept_from = dt.date(2024, 3, 4)
    store.expire(kept_from)
    assert {r.window_date for r in store.read().collect()} == {dt.date(2024, 3, 4), dt.date(2024, 3, 5)}
    assert reader.count() == 10
    run = store.manifest().runs[0].name
    store.vacuum(keep=1)
    left = [n for n in files.names(spark, f"{tmp_path}/runs/run={run}") if n.startswith("window_date")]
    assert left == ["window_date=2024-03-04", "window_date=2024-03-05"]
    store.load(batch(spark, [row(86_400 * 9, 9)]))
    store.expire(dt.date(2024, 3, 1))  # an earlier bound brings nothing back
    assert store.read().count() == 5 and store.manifest().expired_before == "2024-03-04"


def test_newest_first_opens_few_dates(spark, tmp_path):
    store = MetricStore(spark, str(tmp_path))
    store.load(batch(spark, [row(86_400 * d + s, d, route) for d in range(6) for s in (0, 10, 20) for route in ("a", "b")]))
    rows = store.newest(5)
    assert rows.select("window_date").distinct().count() == 1
    assert "2024-03-01" not in rows._jdf.queryExecution().executedPlan().toString()
    assert store.newest(7).select("window_date").distinct().count() == 2
    assert store.newest(10_000).count() == 36
    assert store.newest(4, F.col("route") == "b").count() >= 4
    assert store.read(end=dt.date(2024, 3, 2), window_type="tumbling_10s").count() == 12


def test_empty_store(spark, tmp_path):
    store = MetricStore(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        store.read()
    store.commit(batch(spark, []), 0)
    assert content(store) == [] and store.newest(3).count() == 0
