"""The record log: offsets, polls, positions, retention and the streaming source."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from transitlens.sources.bus import RecordLog, stream_log
from transitlens.streaming import stream as S


def records(spark, start, n, keys=7):
    return spark.range(start, start + n, 1, 4).select(
        F.when(F.col("id") % 11 != 0, (F.col("id") % keys).cast("string")).alias("key"), F.col("id").cast("string").alias("value"))


def test_offsets_are_gapless_and_keys_keep_their_order(spark, tmp_path):
    log = RecordLog(spark, str(tmp_path), "t")
    log.publish(records(spark, 0, 500), 3)
    ends = log.publish(records(spark, 500, 300), 3)
    rows = log.read().collect()
    assert sum(ends.values()) == 800 and sorted(int(r.value) for r in rows) == list(range(800))
    for p, end in ends.items():
        assert sorted(r.offset for r in rows if r.partition == p) == list(range(end))
    for key in {r.key for r in rows if r.key is not None}:
        mine = sorted((r for r in rows if r.key == key), key=lambda r: r.offset)
        assert len({r.partition for r in mine}) == 1 and [int(r.value) for r in mine] == sorted(int(r.value) for r in mine)
    with pytest.raises(ValueError):
        log.publish(records(spark, 0, 1), 2)


def test_hot_key_and_empty_segment(spark, tmp_path):
    log = RecordLog(spark, str(tmp_path), "t")
    log.publish(records(spark, 0, 0), 3)
    assert log.ends() == {0: 0, 1: 0, 2: 0} and log.read().count() == 0
    ends = log.publish(records(spark, 0, 1000, keys=1).withColumn("key", F.lit("hot")), 3)
    assert sorted(ends.values()) == [0, 0, 1000]


def test_order_of_publishing(spark, tmp_path):
    log = RecordLog(spark, str(tmp_path), "t")
    log.publish(records(spark, 0, 400).withColumn("rank", -F.col("value").cast("int")), 1, order=["rank"])
    assert [int(r.value) for r in log.read().orderBy("offset").collect()] == list(range(399, -1, -1))
    newest = log.read(log.back(10)).collect()
    assert sorted(int(r.value) for r in newest) == list(range(10))


def test_polls_are_bounded_and_resume_from_a_stored_position(spark, tmp_path):
    log = RecordLog(spark, str(tmp_path), "t")
    log.publish(records(spark, 0, 250), 3)
    assert log.position("live") is None
    position, seen = {}, []
    while True:
        rows, position = log.poll(position, 100)
        got = [r.value for r in rows.collect()]
        assert len(got) <= 100
        seen += got
        log.commit("live", position)
        if not got:
            break
        position = RecordLog(spark, str(tmp_path), "t").position("live")  # as a restarted consumer finds it
    assert sorted(map(int, seen)) == list(range(250)) and log.position("live") == log.ends()
    log.publish(records(spark, 250, 5), 3)
    rows, _ = log.poll(position, 100)
    assert rows.count() == 5


def test_trimmed_segments_are_gone(spark, tmp_path):
    log = RecordLog(spark, str(tmp_path), "t")
    for k in range(4):
        log.publish(records(spark, 10 * k, 10), 2)
    log.trim(2)
    assert sorted(int(r.value) for r in log.read().collect()) == list(range(20, 40))
    assert sum(log.ends().values()) == 40 and sum(log.begins().values()) == 20


def test_stream_resumes_by_offset(spark, tmp_path):
    log = RecordLog(spark, f"{tmp_path}/bus", "t")
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"

    def run():
        S.run_to_end(S.start_files(stream_log(spark, f"{tmp_path}/bus", "t"), out, checkpoint, trigger="availableNow"), 120)
        return sorted((r.partition, r.offset, r.key or "", r.value) for r in spark.read.parquet(out).collect())

    log.publish(records(spark, 0, 120), 3)
    assert len(run()) == 120
    log.publish(records(spark, 120, 60), 3)
    log.publish(records(spark, 180, 20), 3)
    assert run() == sorted((r.partition, r.offset, r.key or "", r.value) for r in log.read().collect())
    assert len(run()) == 200
