"""Historical and live query rules on a few stored records."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from transitlens.plans import queries as Q

T0 = dt.datetime(2024, 3, 5, 7, 15, 0)
T1 = dt.datetime(2024, 3, 5, 7, 15, 10)
METRIC_SCHEMA = ("window_start timestamp_ntz, window_end timestamp_ntz, route string, "
                 "direction string, window_type string, vehicle_count bigint, "
                 "active_vehicles bigint, avg_speed double, avg_delay double, min_delay int, "
                 "max_delay int")


def stored(spark, extra=()):
    rows = [(T0 - dt.timedelta(seconds=10), T0, "550", "1", "tumbling_10s", 4, 3, 8.25, 12.0,
             -20, 45),
            (T1 - dt.timedelta(seconds=10), T1, "550", "1", "tumbling_10s", 10, 6, 9.75, -3.0,
             -50, 60), *extra]
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def test_metrics_no_filter_returns_both(spark):
    out = Q.metrics(stored(spark)).collect()
    assert len(out) == 2
    assert out[0].timestamp == T1  # newest first within the series


def test_metrics_limit_is_per_series(spark):
    extra = [(T0, T1, "17B", "2", "tumbling_10s", 1, 1, 1.0, 1.0, 0, 0)]
    df = stored(spark, extra)
    assert Q.metrics(df, limit=1).count() == 2  # one per series
    assert Q.metrics(df, limit=1, per_series=False).count() == 1


def test_limit_bounds(spark):
    for bad in (0, 10_001, "5"):
        with pytest.raises(ValueError):
            Q.metrics(stored(spark), limit=bad)


def test_nulls_become_defaults(spark):
    extra = [(T0, T1, None, "2", "sliding_60s", 3, None, None, None, None, None)]
    r = Q.metrics(stored(spark, extra), direction="2").first()
    assert (r.route, r.active_vehicles, r.avg_speed, r.avg_delay, r.min_delay, r.max_delay) == \
        ("", 0, 0.0, 0.0, 0, 0)


def test_time_range_rules(spark):
    df = stored(spark)
    assert Q.metrics(df, start=T1).count() == 1          # [start, open)
    assert Q.metrics(df, end=T1).count() == 1            # (open, end)
    assert Q.metrics(df, start=T0, end=T1).count() == 1  # half-open
    as_of = T1 + dt.timedelta(hours=1)
    assert Q.metrics(df, as_of=as_of).count() == 2       # last 24 h before as_of
    assert Q.metrics(df, as_of=T1 + dt.timedelta(days=2)).count() == 0
    # start only, with as_of: stop at as_of
    assert Q.metrics(df, start=T0, as_of=T1).count() == 1
    # aware datetimes are converted to UTC
    aware = dt.datetime(2024, 3, 5, 9, 15, 10, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert Q.metrics(df, start=aware).count() == 1


def test_route_stats_fixture(spark):
    r = Q.route_stats(stored(spark), route="550").first()
    assert (r.avg_vehicle_count, round(r.avg_speed, 6), r.avg_delay, r.total_observations,
            r.n_rows) == (7.0, 9.0, 4.5, 7, 2)


def test_route_stats_range_needs_both_ends(spark):
    df = stored(spark)
    assert Q.route_stats(df, start=T1).first().n_rows == 2  # lone start ignored
    assert Q.route_stats(df, start=T1, end=T1 + dt.timedelta(seconds=1)).first().n_rows == 1


def test_series_means_long(spark):
    got = {r.field: r.mean for r in Q.series_means(stored(spark)).collect()}
    assert got["vehicle_count"] == 7.0 and round(got["avg_speed"], 6) == 9.0
    assert got["avg_delay"] == 4.5


def test_routes_sorted_distinct_non_empty(spark):
    extra = [(T0, T1, "17B", "2", "tumbling_10s", 1, 1, 1.0, 1.0, 0, 0),
             (T0, T1, "", "2", "tumbling_10s", 1, 1, 1.0, 1.0, 0, 0),
             (T0, T1, None, "2", "tumbling_10s", 1, 1, 1.0, 1.0, 0, 0)]
    got = [r.route for r in Q.routes(stored(spark, extra)).collect()]
    assert got == ["17B", "550"]


def live(spark):
    rows = [(T0, T1, "north", "1", "tumbling_10s", 4, 1, 1.0, 1.0, 0, 0),
            (T0, T0, "south", "2", "tumbling_10s", 9, 1, 1.0, -1.0, 0, 0)]
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def test_live_filters(spark):
    df = live(spark)
    assert Q.live_view(df, tail=100).count() == 2
    assert Q.live_view(df, route="", direction="", tail=100).count() == 2
    c = Q.live_view_counts(df, route="north", tail=100).first()
    assert (c.shown, c.total, c.avg_vehicle_count) == (1, 2, 4.0)
    c = Q.live_view_counts(df, direction="1", tail=100).first()
    assert (c.shown, c.total) == (1, 2)
    assert Q.live_view(df, tail=1).first().route == "north"  # newest message only


def test_latest_known(spark):
    r = Q.latest_known(stored(spark)).collect()
    assert len(r) == 1 and r[0].window_end == T1 and r[0].vehicle_count == 10


def test_summary_and_display(spark):
    s = Q.summary_stats(stored(spark))
    d = Q.display_summary(s).first()
    assert (d.total_records, d.avg_vehicle_count, d.avg_speed, d.avg_delay, d.delay_color) == \
        (2, "7.0", "9.00 m/s", "4.5 s", "normal")


def test_chart_series_order_and_flag(spark):
    rows = Q.chart_series(live(spark)).filter(F.col("metric") == "avg_delay").collect()
    assert [r.window_end for r in rows] == [T0, T1]
    assert [r.late for r in rows] == [False, True]


def test_raw_table_formats_time(spark):
    r = Q.raw_table(Q.metrics(stored(spark))).first()
    assert r.timestamp == "2024-03-05 07:15:10"


def test_historical_view_window(spark):
    df = stored(spark)
    out = Q.historical_view(df, "550", "1", as_of=T1 + dt.timedelta(seconds=1),
                            lookback=dt.timedelta(seconds=5))
    assert [r.timestamp for r in out.collect()] == [T1]


def test_audit_rollup(spark):
    lines = ['{"timestamp": "t", "event_type": "api_request", "path": "/api/v1/metrics", '
             '"response_code": 200}',
             '{"timestamp": "t", "event_type": "api_request", "response_code": 401}',
             '{"timestamp": "t", "service": "stream-processor", "event_type": "service_startup"}',
             'not json']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {(r.event_type, r.response_code): r.events for r in Q.audit_rollup(df).collect()}
    assert got == {("api_request", 200): 1, ("api_request", 401): 1, ("service_startup", None): 1}


def test_no_limit_keeps_all(spark):
    extra = [(T0, T0 + dt.timedelta(seconds=n), "550", "1", "sliding_60s", n, 1, 1.0, 1.0, 0, 0) for n in range(1500)]
    df = stored(spark, extra)
    assert Q.metrics(df).count() == 1502 and Q.metrics(df, limit=7).count() == 9
