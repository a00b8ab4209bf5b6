"""Property-based checks against brute-force Python references."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transitlens.functions.columns import topic_filter_regex, vehicle_key
from transitlens.operators.windows import window_spans

LEVEL = st.sampled_from(["a", "b", "veh", "", "x.y", "1"])


def mqtt_match(flt: str, topic: str) -> bool:
    """Brute-force MQTT filter matching, level by level."""
    f, t = flt.split("/"), topic.split("/")
    for i, lv in enumerate(f):
        if lv == "#":
            return True
        if i >= len(t):
            return False
        if lv != "+" and lv != t[i]:
            return False
    return len(f) == len(t)


def py_key(topic: str):
    parts = topic.split("/")
    if "veh" in parts:
        i = parts.index("veh")
        if i + 1 < len(parts) and parts[i + 1]:
            return parts[i + 1]
    return None


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(LEVEL, min_size=1, max_size=5), min_size=1, max_size=20),
       st.lists(st.sampled_from(["a", "b", "+", "veh", ""]), min_size=1, max_size=4),
       st.booleans())
def test_topic_filter_and_key_match_bruteforce(spark, topics, flt_levels, hash_tail):
    flt = "/".join(flt_levels + (["#"] if hash_tail else []))
    rows = ["/".join(t) for t in topics]
    df = spark.createDataFrame([(r,) for r in rows], "topic string")
    got = df.select("topic", F.col("topic").rlike(topic_filter_regex(flt)).alias("m"),
                    vehicle_key(F.col("topic")).alias("k")).collect()
    for r in got:
        assert r.m == mqtt_match(flt, r.topic), (flt, r.topic)
        assert r.k == py_key(r.topic), r.topic


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(min_value=-10**11, max_value=10**11), min_size=1, max_size=30),
       st.sampled_from([(10, 10), (60, 10), (3600, 600), (21600, 3600)]))
def test_window_spans_match_window(spark, micros, spec):
    length, slide = spec
    ts = [dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=m) for m in micros]
    df = spark.createDataFrame([(t,) for t in ts], "event_time timestamp_ntz")
    spans = df.select("event_time", F.explode(window_spans(
        "event_time", [("w", f"{length} seconds", f"{slide} seconds")])).alias("s")).select(
        "event_time", F.timestamp_micros("s.start_us").cast("timestamp_ntz").alias("start"))
    ref = df.select("event_time", F.window("event_time", f"{length} seconds",
                                            f"{slide} seconds").start.alias("start"))
    assert spans.exceptAll(ref).count() == 0 and ref.exceptAll(spans).count() == 0
