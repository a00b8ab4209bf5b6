"""Properties of the window core and the extension operators."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from transitlens.operators import extensions as X
from transitlens.operators import reshape as R
from transitlens.operators import sinks as K
from transitlens.operators.store import MetricStore
from transitlens.operators import windows as W
from transitlens.plans.registry import metric_table, positions
from transitlens.schema import METRIC_COLUMNS


def test_sliding_counts_sum_to_six_times_rows(spark):
    pos = positions(spark, SF_SMALL)
    s = W.window_metrics(pos, "60 seconds", "10 seconds", label="s")
    assert s.agg(F.sum("vehicle_count")).first()[0] == 6 * pos.count()


def test_pane_form_equals_direct_form(spark):
    pos = positions(spark, SF_SMALL)
    direct = W.window_metrics(pos, "60 seconds", "10 seconds", label="sliding_60s")
    panes = W.sliding_from_panes(pos, "60 seconds", "10 seconds")
    keys = ["window_start", "window_end", "route", "direction"]
    j = direct.alias("d").join(panes.alias("p"), keys)
    assert j.count() == direct.count() == panes.count()
    bad = j.filter((F.col("d.vehicle_count") != F.col("p.vehicle_count"))
                   | (F.abs(F.col("d.avg_speed") - F.col("p.avg_speed")) > 1e-9)
                   | (F.abs(F.col("d.avg_delay") - F.col("p.avg_delay")) > 1e-9)
                   | (F.col("d.min_delay") != F.col("p.min_delay"))
                   | (F.col("d.max_delay") != F.col("p.max_delay"))
                   | (F.col("d.active_vehicles") != F.col("p.active_vehicles")))
    assert bad.count() == 0


def test_approx_distinct_within_bound(spark):
    exact = metric_table(spark, SF_SMALL, exact=True)
    approx = metric_table(spark, SF_SMALL, exact=False)
    keys = ["window_start", "window_end", "route", "direction", "window_type"]
    j = exact.alias("e").join(approx.alias("a"), keys)
    assert j.count() == exact.count()
    # HLL++ default relative standard deviation is 5%; allow 4 sigma plus one.
    bad = j.filter(F.abs(F.col("e.active_vehicles") - F.col("a.active_vehicles"))
                   > F.col("e.active_vehicles") * 0.2 + 1)
    assert bad.count() == 0
    # Large groups: daily distinct vehicles per route over the whole table.
    pos = positions(spark, SF_SMALL)
    d_exact = W.window_metrics(pos, "1 day", exact=True).select(*keys[:4], "active_vehicles")
    d_apx = W.window_metrics(pos, "1 day", exact=False).select(*keys[:4], "active_vehicles")
    jj = d_exact.alias("e").join(d_apx.alias("a"), keys[:4])
    assert jj.filter(F.abs(F.col("e.active_vehicles") - F.col("a.active_vehicles"))
                     > F.col("e.active_vehicles") * 0.2 + 1).count() == 0


def test_long_then_pivot_is_identity(spark):
    m = metric_table(spark, SF_SMALL)
    back = R.metrics_pivot(R.metrics_long(m))
    wide = m.select(F.col("window_end").alias("_time"), "route", "direction", "window_type",
                    *[F.col(c).cast("double").alias(c) for c in METRIC_COLUMNS[5:]])
    assert back.count() == m.count()
    assert wide.exceptAll(back.select(wide.columns)).count() == 0


def test_long_drops_null_and_nan_fields_keeps_row(spark):
    df = spark.createDataFrame(
        [("2025-01-01 12:00:10", "1001", "1", "tumbling_10s", 2, 2, float("nan"), None, -1, 3)],
        "window_end string, route string, direction string, window_type string, "
        "vehicle_count bigint, active_vehicles bigint, avg_speed double, avg_delay double, "
        "min_delay int, max_delay int").withColumn("window_end", F.to_timestamp("window_end"))
    long = R.metrics_long(df)
    assert sorted(r._field for r in long.collect()) == sorted(
        ["vehicle_count", "active_vehicles", "min_delay", "max_delay"])
    line = K.line_protocol(df).first().value
    assert "avg_speed" not in line and "avg_delay" not in line
    assert line.startswith("vehicle_metrics,route=1001,direction=1,window_type=tumbling_10s ")
    assert "vehicle_count=2i" in line and line.endswith(" 1735732810000000000")


def test_line_protocol_escapes_tags(spark):
    df = spark.createDataFrame([("a b,c=d", "1", "t", 1)],
                               "route string, direction string, window_type string, "
                               "vehicle_count bigint").withColumn(
        "window_end", F.lit("2025-01-01 00:00:00").cast("timestamp"))
    for c in ["active_vehicles", "avg_speed", "avg_delay", "min_delay", "max_delay"]:
        df = df.withColumn(c, F.lit(None).cast("double"))
    line = K.line_protocol(df).first().value
    assert line.startswith("vehicle_metrics,route=a\\ b\\,c\\=d,direction=1")


def test_acceleration_bucket_carry_matches_plain_lag(spark):
    """Tiny buckets put almost every predecessor in an earlier bucket; the
    carry rows must reproduce the unsplit per-vehicle lag exactly."""
    pos = positions(spark, SF_SMALL)
    split = X.acceleration(pos, bucket="10 minutes")
    w = Window.partitionBy("vehicle_id").orderBy("event_time", "event_id")
    dt_s = (F.unix_micros(F.col("event_time").cast("timestamp"))
            - F.unix_micros(F.lag("event_time").over(w).cast("timestamp"))) / 1e6
    plain = pos.select("event_id", F.try_divide(F.col("speed") - F.lag("speed").over(w),
                                                F.when(dt_s != 0, dt_s)).alias("acc"))
    j = split.join(plain, "event_id")
    assert j.count() == pos.count()
    assert j.filter(~F.col("acceleration").eqNullSafe(F.col("acc"))).count() == 0
    assert split.filter(F.col("acceleration").isNull()).count() == \
        pos.select("vehicle_id").distinct().count()


def test_downsample_weighted_means(spark):
    rows = [("2025-01-01 12:00:00", "2025-01-01 12:00:10", 3, 10.0, 0.0, 0, 0, 1, 1),
            ("2025-01-01 12:00:10", "2025-01-01 12:00:20", 3, 20.0, 4.0, -1, 9, 1, 3),
            ("2025-01-01 12:00:20", "2025-01-01 12:00:30", 2, None, None, None, None, 0, 0)]
    df = spark.createDataFrame(rows, "window_start string, window_end string, vehicle_count "
                                     "bigint, avg_speed double, avg_delay double, min_delay int, "
                                     "max_delay int, speed_n bigint, delay_n bigint") \
        .withColumn("window_start", F.to_timestamp("window_start")) \
        .withColumn("window_end", F.to_timestamp("window_end")) \
        .withColumn("route", F.lit("r")).withColumn("direction", F.lit("1")) \
        .withColumn("window_type", F.lit("tumbling_10s"))
    out = X.downsample(df, "1 hour").first()
    assert (out.vehicle_count, out.avg_speed, out.avg_delay, out.min_delay, out.max_delay) == \
        (8, 15.0, 3.0, -1, 9)


def test_range_validation_reasons(spark):
    df = spark.createDataFrame([(50.0, 0), (150.0, 0), (-1.0, 99), (10.0, -41)],
                               "speed double, delay int")
    got = {r.reason: r.rows for r in X.range_validation(df).collect()}
    assert got == {"valid": 1, "speed_out_of_range": 2, "delay_out_of_range": 2}


def test_csv_export(spark, tmp_path):
    m = metric_table(spark, SF_SMALL).limit(50)
    out = os.path.join(str(tmp_path), "csv")
    K.write_csv(m, out)
    back = spark.read.option("header", "true").csv(out)
    assert back.count() == 50 and back.columns == m.columns


def test_store_prunes_partitions(spark, tmp_path):
    import datetime as dt
    m = metric_table(spark, SF_SMALL)
    store = MetricStore(spark, os.path.join(str(tmp_path), "store"))
    store.load(m)
    day = dt.date(2024, 1, 15)
    df = store.read(start=day, end=day, window_type="tumbling_10s")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "window_date" in plan
    assert df.count() == m.filter((F.to_date("window_end") == F.lit(day))
                                  & (F.col("window_type") == "tumbling_10s")).count()


@pytest.mark.parametrize("accuracy,grid", [(50, 64), (10_000, 2048)])
def test_exact_percentiles_match_bruteforce_with_skew_and_ties(spark, accuracy, grid):
    import numpy as np
    rng = np.random.default_rng(7)
    rows = []
    for g, size in (("hot", 6000), ("a", 3000), ("b", 2500), ("tiny", 1), ("two", 2)):
        vals = rng.normal(10, 3, size).round(3)
        vals[: size // 4] = 0.0  # a heavy tie
        rows += [(g, float(v)) for v in vals]
    df = spark.createDataFrame(rows, "g string, speed double")
    probs = (0.0, 0.25, 0.5, 0.95, 1.0)
    got = {r.g: r for r in X.exact_percentiles(df, ["g"], "speed", probs,
                                                               accuracy=accuracy, grid_size=grid).collect()}
    for g in {r[0] for r in rows}:
        vals = np.array([v for gg, v in rows if gg == g])
        for p in probs:
            want = float(np.percentile(vals, p * 100, method="linear"))
            have = got[g][f"speed_p{int(round(p * 100))}"]
            assert have is not None and abs(have - want) < 1e-9, (g, p, have, want)


def test_metric_messages_round_trip_and_skip_bad(spark):
    from transitlens.operators.decode import metrics_from_messages
    m = metric_table(spark, SF_SMALL)
    msgs = K.metrics_json(K.with_processed_at(m))
    back = metrics_from_messages(msgs).drop("processed_at")
    assert back.count() == m.count()
    assert back.select(m.columns).exceptAll(m).count() == 0  # exact values and µs times
    bad = spark.createDataFrame([(None,), ("not json",), ('{"route": "1"}',),
                                 ('{"window_end": "2024-01-01T00:00:10.000000", "direction": "2"}',)],
                                "value string")
    got = metrics_from_messages(bad).collect()
    assert len(got) == 1 and got[0].route == "" and got[0].direction == "2"


def test_approximate_percentiles_close_to_exact(spark):
    pos = positions(spark, SF_SMALL)
    keys = ["route", "direction"]
    exact = X.speed_percentiles(pos, exact=True)
    approx = X.speed_percentiles(pos, exact=False)
    assert exact.columns == approx.columns
    j = exact.alias("e").join(approx.alias("a"), keys)
    assert j.count() == exact.count()
    # rank error 1/10000 on ~100 rows per group: the sketch returns an actual
    # order statistic next to the interpolated exact value
    for c in [c for c in exact.columns if c not in keys]:
        worst = j.select(F.max(F.abs(F.col(f"e.{c}") - F.col(f"a.{c}")))).first()[0]
        spread = pos.select(F.max("speed") - F.min("speed")).first()[0] if "speed" in c \
            else pos.select(F.max("delay") - F.min("delay")).first()[0]
        assert worst <= 0.25 * spread, (c, worst)


def test_pane_sketch_variant_within_bound(spark):
    pos = positions(spark, SF_SMALL)
    exact = W.sliding_from_panes(pos, exact=True)
    sketch = W.sliding_from_panes(pos, exact=False)
    keys = ["window_start", "window_end", "route", "direction"]
    j = exact.alias("e").join(sketch.alias("s"), keys)
    assert j.count() == exact.count() == sketch.count()
    assert j.filter(F.col("e.vehicle_count") != F.col("s.vehicle_count")).count() == 0
    assert j.filter(F.abs(F.col("e.active_vehicles") - F.col("s.active_vehicles"))
                    > F.col("e.active_vehicles") * 0.05 + 1).count() == 0


def test_line_protocol_odd_values(spark):
    """Null and empty tags and non-finite fields are left out; breaks and backslashes stay in their point."""
    rows = [(None, "1", "t", 1, float("inf"), float("nan")), ("", "1", "t", 1, 2.5, -float("inf")), ("a\nb\\", "1", "t", 1, None, None),
            ("x", "1", "t", None, float("nan"), None)]
    df = spark.createDataFrame(rows, "route string, direction string, window_type string, vehicle_count bigint, "
                                     "avg_speed double, avg_delay double")
    df = df.withColumn("window_end", F.lit("2024-03-05 07:15:00").cast("timestamp"))
    for c in ["active_vehicles", "min_delay", "max_delay"]:
        df = df.withColumn(c, F.lit(None).cast("double"))
    got = [r.value for r in K.line_protocol(df).collect()]
    at = " 1709622900000000000"
    assert got == ["vehicle_metrics,direction=1,window_type=t vehicle_count=1i" + at,
                   "vehicle_metrics,direction=1,window_type=t vehicle_count=1i,avg_speed=2.5" + at,
                   "vehicle_metrics,route=a\\nb\\\\,direction=1,window_type=t vehicle_count=1i" + at]


def test_percentiles_keep_null_and_empty_groups(spark):
    rows = [(None, "1", float(i), i) for i in range(11)] + [("a", None, 3.0, None), ("b", "2", None, None)]
    df = spark.createDataFrame(rows, "route string, direction string, speed double, delay int")
    got = {(r.route, r.direction): (r.speed_p50, r.delay_p50) for r in X.speed_percentiles(df).collect()}
    assert got == {(None, "1"): (5.0, 5.0), ("a", None): (3.0, None), ("b", "2"): (None, None)}


def test_pane_sketches_merge_to_any_window(spark):
    """Rank errors of merged sketches against all values, a null group and a skewed one."""
    rows = spark.range(40_000).select(
        F.timestamp_seconds(F.col("id") % 7200).cast("timestamp_ntz").alias("event_time"),
        F.when(F.col("id") % 3 == 0, F.lit("a")).when(F.col("id") % 100 == 1, F.lit("none")).otherwise(F.lit(None)).alias("route"),
        F.lit("1").alias("direction"), F.col("id").alias("vehicle_id"),
        F.when(F.col("id") % 3 == 0, F.pow(F.col("id") % 1009, F.lit(3.0))).when(F.col("id") % 100 == 1, F.lit(float("nan")))
        .otherwise((F.col("id") % 5).cast("double")).alias("speed"), (F.col("id") % 13).alias("delay"))
    panes = X.pane_sketches(rows)
    for length, slide in (("1 hour", None), ("60 seconds", "20 seconds")):
        got = X.merged_percentiles(panes, length, slide)
        window = F.window("event_time", length, slide) if slide else F.window("event_time", length)
        v = F.when(~F.isnan("speed"), F.col("speed"))
        exact = rows.withColumn("w", window).groupBy(F.col("w.start").alias("window_start"), "route").agg(
            F.sort_array(F.collect_list(v)).alias("v"))
        want = {(r.window_start, r.route): r.v for r in exact.collect()}
        seen = got.collect()
        assert len(seen) == len(want)
        for r in seen:
            values = want[r.window_start, r.route]
            assert r.speed_n == len(values) and (r.speed_p50 is None) == (not values)
            for p, q in ((0.5, r.speed_p50), (0.95, r.speed_p95)):
                if values:
                    assert sum(x < q for x in values) / len(values) <= p + 0.03
                    assert sum(x <= q for x in values) / len(values) >= p - 0.03


def test_levels_come_from_one_scan(spark):
    plan = X.metrics_by_level(positions(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_levels_tell_missing_keys_apart(spark):
    rows = spark.sql("""SELECT TIMESTAMP_NTZ'2024-01-01 00:00:01' AS event_time, r AS route, '1' AS direction, v AS vehicle_id,
                               CAST(v AS DOUBLE) AS speed, CAST(NULL AS BIGINT) AS delay
                        FROM VALUES (CAST(NULL AS STRING), 1L), (NULL, 2L), ('a', 2L) AS t(r, v)""")
    got = {(r.level, r.route): (r.vehicle_count, r.active_vehicles, r.avg_speed, r.avg_delay) for r in X.metrics_by_level(rows).collect()}
    assert got == {("route_direction", None): (2, 2, 1.5, None), ("route_direction", "a"): (1, 1, 2.0, None), ("route", None): (2, 2, 1.5, None),
                   ("route", "a"): (1, 1, 2.0, None), ("network", None): (3, 2, 5 / 3, None)}


def test_percentile_ranks_are_split_into_cells(spark):
    """The window over a bracket sees its cells only; values are ranked inside one cell."""
    plan = X.speed_percentiles(positions(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [sum(" in line]
    assert len(windows) >= 2 and all("_cell" in line for line in windows)
