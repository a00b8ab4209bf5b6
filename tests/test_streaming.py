"""Streaming semantics: late data, one vs. two state stores, multi-sink
idempotence and restart from a checkpoint (FIXTURES §6)."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from transitlens.operators.reshape import upsert_latest
from transitlens.session import shared_path
from transitlens.streaming import stream as S

SCHEMA = "ts string, r string, v int"


def _write_batch(folder, name, rows, mtime):
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        for ts, v in rows:
            fh.write(json.dumps({"ts": f"2025-01-01T12:{ts}Z", "r": "1001", "v": v}) + "\n")
    os.utime(path, (mtime, mtime))


def _late_stream(spark, folder):
    src = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(folder)
           .select(F.to_timestamp("ts").alias("event_time"), F.col("r").alias("route"),
                   F.lit("1").alias("direction"), F.col("v").alias("vehicle_id"),
                   F.col("v").cast("double").alias("speed"), F.col("v").alias("delay")))
    return src


def _files(tmp, with_spare=True):
    folder = os.path.join(tmp, "in")
    os.makedirs(folder)
    base = time.time() - 100
    _write_batch(folder, "f0.json", [("00:01", 1), ("00:09", 2)], base)
    _write_batch(folder, "f1.json", [("02:00", 3)], base + 1)
    if with_spare:
        _write_batch(folder, "f2.json", [("02:01", 4)], base + 2)
    _write_batch(folder, "f3.json", [("00:05", 5), ("01:30", 6)], base + 3)
    return folder


def _run_update(spark, folder, tmp):
    src = _late_stream(spark, folder)
    agg = (src.withWatermark("event_time", "1 minute")
           .groupBy(F.window("event_time", "10 seconds").alias("w"), "route")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("vehicle_id").alias("s")))
    out = os.path.join(tmp, "out")
    q = S.start_update(agg, out, os.path.join(tmp, "chk"), trigger="availableNow")
    S.run_to_end(q, 120)
    rows = spark.read.parquet(out).collect()
    return q, rows


def test_late_row_dropped_after_spare_batch(spark, tmp_path):
    folder = _files(str(tmp_path))
    q, rows = _run_update(spark, folder, str(tmp_path))
    emitted = {(r.batch_id, r.w.start.strftime("%H:%M:%S")): (r.n, r.s) for r in rows}
    assert emitted[(0, "12:00:00")] == (2, 3)
    assert emitted[(1, "12:02:00")] == (1, 3)
    assert emitted[(2, "12:02:00")] == (2, 7)
    assert emitted[(3, "12:01:30")] == (1, 6)
    assert not any(b == 3 and w == "12:00:00" for b, w in emitted)
    assert S.dropped_by_watermark(q) == 1


def test_late_row_counted_without_spare_batch(spark, tmp_path):
    folder = _files(str(tmp_path), with_spare=False)
    q, rows = _run_update(spark, folder, str(tmp_path))
    late = [r for r in rows if r.w.start.strftime("%H:%M:%S") == "12:00:00" and r.batch_id > 0]
    assert late and late[0].n == 3  # watermark of the previous batch still admits it
    assert S.dropped_by_watermark(q) == 0


def test_single_state_append_drops_tumbling_and_sliding(spark, tmp_path):
    folder = _files(str(tmp_path))
    pos = _late_stream(spark, folder)
    agg = S.streaming_metrics(pos, single_state=True)
    out = os.path.join(str(tmp_path), "out")
    q = S.start_files(agg, out, os.path.join(str(tmp_path), "chk"), trigger="availableNow")
    S.run_to_end(q, 120)
    assert S.dropped_by_watermark(q) == 7
    assert spark.read.parquet(out).count() == 7
    plan_ops = [op for p in q.recentProgress for op in p.stateOperators]
    assert {len(p.stateOperators) for p in q.recentProgress if p.stateOperators} == {1}
    assert plan_ops


def test_single_and_two_state_forms_agree_on_events(spark):
    from transitlens.plans.registry import positions
    pos = S.event_time_ts(positions(spark, "/root/testdata/sf0.001"))
    one = S.streaming_metrics(pos, single_state=True)
    two = S.streaming_metrics(pos, single_state=False)
    cols = ["window_start", "window_type", "route", "direction", "vehicle_count", "min_delay"]
    assert one.select(cols).exceptAll(two.select(cols)).count() == 0
    assert two.select(cols).exceptAll(one.select(cols)).count() == 0
    assert one.count() == two.count() > 0


def test_multi_sink_idempotent_and_restart(spark, tmp_path):
    """One foreachBatch query writes three sinks; a restart resumes from the
    checkpoint and a replayed batch overwrites its own folder."""
    src_dir = os.path.join(str(tmp_path), "src")
    os.makedirs(src_dir)
    base = time.time() - 100
    _write_batch(src_dir, "a.json", [("00:01", 1), ("00:03", 2)], base)
    root = os.path.join(str(tmp_path), "sinks")
    chk = os.path.join(str(tmp_path), "chk")

    def start():
        pos = _late_stream(spark, src_dir)
        return S.start_multi_sink(S.streaming_metrics(pos), root, chk, trigger="availableNow")

    S.run_to_end(start(), 120)
    _write_batch(src_dir, "b.json", [("00:05", 3), ("03:00", 4)], base + 1)
    S.run_to_end(start(), 120)
    store = spark.read.parquet(os.path.join(root, "store"))
    batches = sorted(r.batch_id for r in store.select("batch_id").distinct().collect())
    assert len(batches) == 2 and batches[0] == 0  # empty no-data batches write nothing
    current = upsert_latest(store.drop("processed_at"),
                            keys=["route", "direction", "window_type", "window_end"])
    w0 = current.filter((F.col("window_type") == "tumbling_10s")
                        & (F.date_format("window_start", "HH:mm:ss") == "12:00:00")).first()
    assert w0.vehicle_count == 3  # state carried across the restart
    points = spark.read.text(os.path.join(root, "points")).collect()
    assert all(p.value.startswith("vehicle_metrics,route=1001") for p in points)
    msgs = spark.read.text(os.path.join(root, "json"))
    assert msgs.count() == store.count()
    # Replaying the last batch (at-least-once) must not duplicate its output.
    last = batches[-1]
    before = store.count()
    rows = store.filter(F.col("batch_id") == last).drop("batch_id", "processed_at")
    replay = spark.createDataFrame(rows.collect(), rows.schema)  # as re-read from the source
    S.multi_sink_writer(root)(replay, last)
    again = spark.read.parquet(os.path.join(root, "store"))
    assert again.count() == before


def test_listener_logs_batches(spark, tmp_path):
    log = S.JsonEventLog()
    spark.streams.addListener(log)
    try:
        src_dir = os.path.join(str(tmp_path), "src")
        os.makedirs(src_dir)
        _write_batch(src_dir, "a.json", [("00:01", 1)], time.time() - 10)
        q = S.start_files(S.with_batch_counters(S.streaming_metrics(_late_stream(spark, src_dir))),
                          os.path.join(str(tmp_path), "o"), os.path.join(str(tmp_path), "c"),
                          trigger="availableNow")
        S.run_to_end(q, 120)
        deadline = time.time() + 10
        while time.time() < deadline and not any('"batch_written"' in x for x in log.lines):
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    lines_before = list(log.lines)
    kinds = {json.loads(x)["event_type"] for x in log.lines}
    assert "batch_written" in kinds
    observed = [json.loads(x).get("observed") for x in log.lines
                if json.loads(x)["event_type"] == "batch_written"]
    assert any(o and "batch_counters" in o for o in observed)
    from transitlens.plans.queries import audit_rollup
    folder = os.path.join(str(tmp_path), "log")
    count = log.flush(spark, folder)
    assert count >= 2 and not {*lines_before} & {*log.lines}
    count += log.flush(spark, folder)
    lines = spark.read.text(folder)
    assert lines.count() == count
    assert audit_rollup(lines).filter("event_type = 'batch_written'").count() >= 1


def test_checkpoint_under_shared_dir(spark):
    path = S.checkpoint_for(spark, "x", unique=True)
    root = spark.sparkContext.getCheckpointDir()
    assert root and path.startswith(root.rstrip("/"))
    assert shared_path(spark, "a").startswith(root.rstrip("/"))


def test_console_sink_runs(spark, tmp_path, capfd):
    src_dir = os.path.join(str(tmp_path), "src")
    os.makedirs(src_dir)
    _write_batch(src_dir, "a.json", [("00:01", 1)], time.time() - 10)
    q = S.start_console(S.streaming_metrics(_late_stream(spark, src_dir)), trigger="availableNow",
                        checkpoint=os.path.join(str(tmp_path), "c"))
    S.run_to_end(q, 120)
    assert any(p["numInputRows"] >= 1 for p in q.recentProgress)


def test_streaming_distinct_forms_within_bound(spark):
    from transitlens.operators.windows import windowed_metrics
    from transitlens.plans.registry import positions
    pos = positions(spark, "/root/testdata/sf0.001")
    exact = windowed_metrics(pos, "1 day", "2 days", "1 day", exact=True)
    keys = ["window_start", "window_type", "route", "direction"]
    for form in ("sketch", "hllpp"):
        apx = S.streaming_metrics(S.event_time_ts(pos), tumbling="1 day", sliding="2 days",
                                  slide="1 day", distinct=form, tumbling_label="tumbling_10s",
                                  sliding_label="sliding_60s")
        apx = apx.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
        j = exact.alias("e").join(apx.alias("a"), keys)
        assert j.count() == exact.count()
        assert j.filter(F.col("e.vehicle_count") != F.col("a.vehicle_count")).count() == 0
        assert j.filter(F.abs(F.col("e.active_vehicles") - F.col("a.active_vehicles"))
                        > F.col("e.active_vehicles") * 0.2 + 1).count() == 0


def test_one_read_plan_update_mode_equals_batch(spark, tmp_path):
    from transitlens.operators.reshape import upsert_latest
    from transitlens.plans.registry import metric_table, stream_positions
    pos = stream_positions(spark, "/root/testdata/sf0.001")
    agg = S.streaming_metrics(pos, plan="one_read")
    out = os.path.join(str(tmp_path), "o")
    q = S.start_update(agg, out, os.path.join(str(tmp_path), "c"), trigger="availableNow")
    S.run_to_end(q, 300)
    assert {p.numInputRows for p in q.recentProgress} <= {0, 1000}  # source read once
    got = upsert_latest(spark.read.parquet(out)).drop("active_vehicles") \
        .withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
        .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    want = metric_table(spark, "/root/testdata/sf0.001").drop("active_vehicles")
    cols = ["window_start", "window_end", "route", "direction", "window_type",
            "vehicle_count", "min_delay", "max_delay"]
    assert got.count() == want.count()
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0


def test_late_arrivals_all_dropped_and_counted(spark, tmp_path):
    import datetime as dt
    from transitlens.sources.readers import read_events
    events = read_events(spark, "/root/testdata/sf0.001")
    feed, out = os.path.join(str(tmp_path), "feed"), os.path.join(str(tmp_path), "out")
    chk = os.path.join(str(tmp_path), "chk")
    cutoff = F.lit(dt.datetime(2024, 1, 16))

    def run():
        src = spark.readStream.schema(events.schema).parquet(feed)
        agg = S.streaming_metrics(S.positions_from_event_stream(src))
        return S.run_to_end(S.start_update(agg, out, chk, trigger="availableNow"), 300)

    events.filter(F.col("ts") >= cutoff).write.mode("append").parquet(feed)
    first = run()
    assert S.dropped_by_watermark(first) == 0
    events.filter(F.col("ts") < cutoff).write.mode("append").parquet(feed)
    second = run()
    late = events.filter(F.col("ts") < cutoff).count()
    # each late row falls in one tumbling and six sliding windows; all are past the watermark
    assert S.dropped_by_watermark(second) == late * 7


def test_unfinished_stream_raises(spark, tmp_path):
    import pytest
    query = S.start_files(spark.readStream.format("rate").load(), os.path.join(str(tmp_path), "o"),
                          os.path.join(str(tmp_path), "c"), trigger="1 second")
    with pytest.raises(TimeoutError):
        S.run_to_end(query, 2)
    assert not query.isActive


def test_cluster_needs_a_shared_folder():
    import pytest
    from transitlens import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
