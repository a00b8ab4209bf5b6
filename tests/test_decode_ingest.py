"""Ingest and decode on a few messages."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from transitlens.functions.columns import topic_filter_regex, topic_level, vehicle_key
from transitlens.operators.decode import decode_positions
from transitlens.operators.windows import window_metrics, windowed_metrics
from transitlens.sources import ingest

FERRY = "fleet/north/veh/F-17/status"
KEYED_TOPICS = {
    FERRY: "F-17",
    "veh/3": "3",
    "/depot/veh/line 9 b/veh/x": "line 9 b",  # the first marker counts
    "/depot/veh/\u00e4\u00f6/2024": "\u00e4\u00f6",
    "/depot/vehicle/12": None,
    "/depot/VEH/12": None,
    "/depot/12/veh": None,
    "/depot/12/veh/": None,
    "": None,
}


def test_vehicle_key(spark):
    df = spark.createDataFrame([(t,) for t in [*KEYED_TOPICS, None]], "topic string")
    got = {r.topic: r.key for r in df.select("topic", vehicle_key(F.col("topic")).alias("key")).collect()}
    assert got == {**KEYED_TOPICS, None: None}


def test_topic_level(spark):
    df = spark.createDataFrame([("/a/b/c",), ("/a",)], "topic string")
    got = [r.x for r in df.select(topic_level(F.col("topic"), 3).alias("x")).collect()]
    assert got == ["b", None]


@pytest.mark.parametrize("flt,topic,ok", [
    ("/hfp/v2/journey/#", "/hfp/v2/journey", True),
    ("/hfp/v2/journey/#", "/hfp/v2/journey/ongoing/vp/bus", True),
    ("/hfp/v2/journey/#", "/hfp/v2/journeyX", False),
    ("/hfp/+/journey", "/hfp/v2/journey", True),
    ("/hfp/+/journey", "/hfp//journey", True),
    ("/hfp/+/journey", "/hfp/v2/x/journey", False),
    ("#", "anything/at/all", True),
    ("a.b/+", "aXb/c", False),
])
def test_topic_filter(spark, flt, topic, ok):
    df = spark.createDataFrame([(topic,)], "topic string")
    assert df.filter(F.col("topic").rlike(topic_filter_regex(flt))).count() == int(ok)


def raw(spark, payloads):
    return spark.createDataFrame([(FERRY, p, 1.0) for p in payloads],
                                 "topic string, payload binary, received_at double")


def test_envelope_and_rejects(spark):
    payload = {"VP": {"desi": "17B", "dir": "2", "stops": [3, 4]}}
    df = raw(spark, [json.dumps(payload).encode(), '{"name": "Hölö"}'.encode(), b'{"VP": {"desi": "17B", ', b'{"VP": "\xc3"}', b"{]"])
    env = ingest.envelope(df).collect()
    assert [json.loads(r.value)["payload"] for r in env] == [payload, {"name": "Hölö"}]
    assert set(json.loads(env[0].value)) == {"mqtt_topic", "payload", "received_at", "schema_version"}
    assert {r.key for r in env} == {"F-17"}
    assert "Hölö" in env[1].value  # non-ASCII kept as is
    assert sorted(r.reject_reason for r in ingest.rejects(df).collect()) == ["json_decode", "json_decode", "utf8"]
    stats = ingest.ingest_stats(df).collect()[0]
    assert (stats.messages_processed, stats.errors, stats.success_rate) == (2, 3, 40.0)


@pytest.mark.parametrize("good,bad,rate", [(0, 0, 100.0), (7, 0, 100.0), (0, 3, 0.0), (2, 1, 66.67), (13, 3, 81.25)])
def test_stats_rates(spark, good, bad, rate):
    s = ingest.ingest_stats(raw(spark, [b"[]"] * good + [b"["] * bad)).collect()[0]
    assert (s.messages_processed, s.errors, s.success_rate) == (good, bad, rate)


def msg(topic, vp):
    return json.dumps({"mqtt_topic": topic, "received_at": 1.0, "payload": {"VP": vp}})


SAMPLES = [
    {"desi": "550", "dir": "2", "veh": 31, "tst": "2024-03-05T07:15:02.250Z", "spd": 4.25,
     "dl": 12, "lat": 61.5, "long": 23.75, "oper": 40},
    {"desi": "550", "dir": "2", "veh": 58, "tst": "2024-03-05T07:15:06.000Z", "spd": 6.75,
     "dl": -8, "lat": 61.52, "long": 23.7, "oper": 40},
    {"desi": "17B", "dir": "1", "veh": 64, "tst": "2024-03-05T07:15:21.000Z", "spd": 15.5,
     "dl": 33, "lat": 61.47, "long": 23.81, "oper": 6},
]


def test_decode_samples(spark):
    df = spark.createDataFrame([(msg("/t", v),) for v in SAMPLES], "value string")
    rows = sorted(decode_positions(df).collect(), key=lambda r: r.vehicle_id)
    assert [(r.route, r.direction, r.vehicle_id, r.speed, r.delay, r.operator) for r in rows] == [
        ("550", "2", 31, 4.25, 12, 40), ("550", "2", 58, 6.75, -8, 40),
        ("17B", "1", 64, 15.5, 33, 6)]
    assert rows[0].event_time == dt.datetime(2024, 3, 5, 7, 15, 2, 250_000)
    assert (rows[1].latitude, rows[1].longitude) == (61.52, 23.7)


def test_decode_drops_incomplete_and_bad(spark):
    whole = SAMPLES[2]
    values = [msg("/t", {k: v for k, v in whole.items() if k != missing}) for missing in ("desi", "dir", "tst")]
    values += [msg("/t", dict(whole, tst="yesterday")), msg("/t", None), msg("/t", []), json.dumps({"payload": whole}),
               msg("/t", whole)[:60], "17", "", None]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    assert decode_positions(df).count() == 0


def test_decode_field_level_nulls(spark):
    base = dict(SAMPLES[0], desi=550)
    cases = {"vehicle_id": [dict(base, veh="31"), dict(base, veh=2 ** 70)], "delay": [dict(base, dl=0.5)], "speed": [dict(base, spd="fast")],
             None: [base, dict(base, doors={"open": True})]}
    for field, messages in cases.items():
        rows = decode_positions(spark.createDataFrame([(msg("/t", v),) for v in messages], "value string")).collect()
        assert len(rows) == len(messages) and all(r.route == "550" for r in rows)  # number into string field → its text
        for r in rows:
            assert {c for c in ("vehicle_id", "delay", "speed", "latitude") if r[c] is None} == ({field} if field else set())


def test_window_on_decoded_samples(spark):
    df = spark.createDataFrame([(msg("/t", v),) for v in SAMPLES], "value string")
    pos = decode_positions(df)
    t = sorted(window_metrics(pos).collect(), key=lambda r: r.window_start)
    assert [(r.vehicle_count, r.active_vehicles, round(r.avg_speed, 6), r.avg_delay, r.min_delay,
             r.max_delay) for r in t] == [(2, 2, 5.5, 2.0, -8, 12), (1, 1, 15.5, 33.0, 33, 33)]
    both = windowed_metrics(pos)
    assert both.count() == 14
    sliding = both.filter(F.col("window_type") == "sliding_60s")
    assert sliding.filter(F.col("route") == "550").agg(F.min("vehicle_count")).first()[0] == 2


def test_static_tumbling_fixture(spark):
    rows = [(dt.datetime(2024, 3, 5, 9, 30, 1), 31, 3.0, 5),
            (dt.datetime(2024, 3, 5, 9, 30, 8), 58, 5.0, -15),
            (dt.datetime(2024, 3, 5, 9, 30, 12), 64, 9.0, 2)]
    df = spark.createDataFrame(rows, "event_time timestamp, vehicle_id bigint, speed double, "
                                     "delay bigint").withColumn("route", F.lit("550")) \
        .withColumn("direction", F.lit("1"))
    out = sorted(window_metrics(df).collect(), key=lambda r: r.window_start)
    assert [(r.vehicle_count, r.avg_speed, r.min_delay, r.max_delay) for r in out] == [
        (2, 4.0, -15, 5), (1, 9.0, 2, 2)]


def test_stats_per_reporting_interval(spark):
    rows = [(FERRY, b"{}", 0.0), (FERRY, b"{", 30.0), (FERRY, b"{}", 61.0), (FERRY, b"{}", 119.0)]
    df = spark.createDataFrame(rows, "topic string, payload binary, received_at double")
    per = ingest.ingest_stats(df, F.window(F.timestamp_seconds("received_at"), "60 seconds")
                              .alias("interval"))
    got = sorted((r.interval.start.second, r.interval.start.minute, r.messages_processed,
                  r.errors, r.success_rate) for r in per.collect())
    assert got == [(0, 0, 1, 1, 50.0), (0, 1, 2, 0, 100.0)]


def test_envelope_files_round_trip(spark, tmp_path):
    from transitlens.plans.registry import raw_messages
    from conftest import SF_SMALL
    raw_df = raw_messages(spark, SF_SMALL)
    records = ingest.envelope(raw_df)
    out = str(tmp_path / "bus")
    ingest.write_envelopes_files(records, out)
    back = spark.read.parquet(out)
    assert back.count() == records.count()
    assert back.exceptAll(records.select("key", "value")).count() == 0
    decoded = decode_positions(back)
    assert decoded.count() == back.count()  # every good envelope decodes


def test_json_is_taken_strictly(spark):
    """Repeated keys, bare NaN and text after the value are rejected."""
    odd = [b'{"a": 1, "a": 2}', b'{"x": NaN}', b'{"x": Infinity}', b"{} {}", b"", b" "]
    fine = [b"{}", b"[1, 2]", b"5", b'"text"', b"null", '{"\u00e4": "\u00f6"}'.encode()]
    assert ingest.envelope(raw(spark, fine)).count() == len(fine)
    assert [r.reject_reason for r in ingest.rejects(raw(spark, odd)).collect()] == ["json_decode"] * len(odd)


def test_nan_speed_is_no_speed(spark):
    text = json.dumps({"mqtt_topic": "/t", "received_at": 1.0, "payload": {"VP": dict(SAMPLES[0], spd=float("nan"))}})
    row = decode_positions(spark.createDataFrame([(text,)], "value string")).first()
    assert row.vehicle_id == 31 and row.speed is None
