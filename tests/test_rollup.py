"""Incremental hourly rows, streaming acceleration and supervision of several queries."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from transitlens.operators.extensions import acceleration, downsample
from transitlens.operators.rollup import refresh
from transitlens.operators.store import MetricStore
from transitlens.sources import files
from transitlens.streaming import stream as S

BEGIN = dt.datetime(2024, 3, 1, 22, 30)
SCHEMA = ("window_start timestamp, window_end timestamp, route string, direction string, window_type string, vehicle_count long, "
          "active_vehicles long, avg_speed double, avg_delay double, min_delay long, max_delay long, speed_n long, delay_n long")


def row(second, n, route="a"):
    start = BEGIN + dt.timedelta(seconds=second)
    return (start, start + dt.timedelta(seconds=10), route, "1", "tumbling_10s", n, n, float(second % 7), 1.0, -n, n, n, n)


def content(df):
    return sorted((r.window_start, r.route, r.vehicle_count, round(r.avg_speed, 9), r.source_rows) for r in df.collect())


def test_only_touched_hours_are_computed(spark, tmp_path):
    source, target = MetricStore(spark, f"{tmp_path}/fine"), MetricStore(spark, f"{tmp_path}/hourly")
    rng = random.Random(2)
    last = {}
    for b in range(6):  # half an hour each, across midnight
        rows = {(s, r): row(s, rng.randint(1, 9), r) for r in "ab" for s in range(1800 * b, 1800 * (b + 1), 300)}
        if b == 5:  # a correction from the first hour
            rows[0, "a"] = row(0, 50)
        last.update(rows)
        source.commit(spark.createDataFrame(list(rows.values()), SCHEMA), b)
        touched = {(v[0].replace(minute=0, second=0)) for v in rows.values()}
        got = refresh(source, target)
        assert got is None if b == 0 and source.manifest().touched_since(-1) is None else got == len(touched)
        want = downsample(spark.createDataFrame(list(last.values()), SCHEMA))
        assert content(target.read()) == content(want)
    assert refresh(source, target) == 0
    source.load(spark.createDataFrame([row(90_000, 1)], SCHEMA))
    assert refresh(source, target) is None and target.read().count() == len({(k[1], v[0].replace(minute=0)) for k, v in last.items()}) + 1


def test_acceleration_state_is_bounded_and_replays_agree(spark, tmp_path):
    rows = [(v, BEGIN + dt.timedelta(seconds=60 * k + v), 100 * k + v, float(k * v % 11)) for k in range(12) for v in range(5) if v != 4 or k == 0]
    frame = spark.createDataFrame(rows, "vehicle_id long, event_time timestamp_ntz, event_id long, speed double")
    write = S.acceleration_writer(str(tmp_path), ttl="5 minutes", keep=2)
    for b in range(12):
        part = frame.filter((F.col("event_id") / 100).cast("int") == b)
        write(part, b)
        if b == 7:
            write(part, b)  # replayed
    assert len(files.names(spark, f"{tmp_path}/state")) <= 4
    state = spark.read.schema(S.LAST_SCHEMA).parquet(f"{tmp_path}/state/b=11").collect()
    assert {r.vehicle_id for r in state} == {0, 1, 2, 3}  # 4 was silent for longer
    got = {(r.event_id): r.acceleration for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = {r.event_id: r.acceleration for r in acceleration(frame).collect()}
    assert got == want and len(got) == len(rows)


def test_first_failure_stops_all(spark, tmp_path):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 5).load()

    def fail(batch, batch_id):
        raise RuntimeError("sink is gone")

    good = rate.writeStream.option("checkpointLocation", f"{tmp_path}/a").foreachBatch(lambda *_: None).start()
    bad = rate.writeStream.option("checkpointLocation", f"{tmp_path}/b").foreachBatch(fail).start()
    with pytest.raises(Exception, match="sink is gone"):
        S.supervise([good, bad], 60)
    assert not good.isActive and not bad.isActive
    slow = rate.writeStream.option("checkpointLocation", f"{tmp_path}/c").foreachBatch(lambda *_: None).start()
    with pytest.raises(TimeoutError):
        S.supervise([slow], 1)
    assert not slow.isActive
