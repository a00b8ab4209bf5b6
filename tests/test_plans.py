"""Plan-shape regression tests: the scale properties the README promises."""

from __future__ import annotations

import re

import pytest

from conftest import SF_SMALL
from transitlens.operators import sinks as K
from transitlens.plans.registry import QUERIES, metric_table, positions, stored_metrics


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def query_plan(spark, key) -> str:
    return plan_of(QUERIES[key](spark, SF_SMALL))


def test_metric_table_reads_input_once(spark):
    plan = plan_of(metric_table(spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 1
    assert "Union" not in plan
    # two aggregation shuffles (single-distinct plan), both after partial aggregation
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_count" in plan


def test_latest_row_is_a_hash_aggregate(spark):
    for key in ("latest_known", "metrics_upsert"):
        plan = query_plan(spark, key)
        assert "SortAggregate" not in plan, key
        assert "max_by" in plan


def test_per_series_top_n_is_limited_before_shuffle(spark):
    plan = query_plan(spark, "metrics_query")
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("key", ["metrics_query", "routes_list", "historical_view", "raw_table", "retention"])
def test_time_range_prunes_date_folders(spark, key):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # untruncated scan info
    try:
        plan = query_plan(spark, key)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "PartitionFilters" in line]
    assert any("window_date" in line.split("PartitionFilters:")[1].split("PushedFilters")[0] for line in scans), plan


def test_stored_questions_do_not_recompute_metrics(spark):
    """Nor do they read the events, not even for "now"."""
    stored_metrics(spark, SF_SMALL)
    for key in ("metrics_query", "metrics_latest_n", "route_stats", "latest_known", "live_view", "live_view_counts", "summary_stats",
                "metrics_latest_global", "routes_list", "historical_view", "raw_table", "retention"):
        assert "events.parquet" not in query_plan(spark, key), key


@pytest.mark.parametrize("key", ["live_view", "live_view_counts", "metrics_latest_global"])
def test_newest_rows_open_few_dates(spark, key):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = query_plan(spark, key)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    dates = set(re.findall(r"window_date=(\d{4}-\d\d-\d\d)", plan))
    assert 1 <= len(dates) <= 2


@pytest.mark.parametrize("key", ["tumbling_metrics", "network_metrics", "acceleration", "speed_percentiles"])
def test_no_round_robin(spark, key):
    assert "RoundRobin" not in query_plan(spark, key)


def test_carry_is_a_hash_aggregate(spark):
    from transitlens.operators.extensions import acceleration
    assert "SortAggregate" not in plan_of(acceleration(positions(spark, SF_SMALL)))


def test_store_write_rebalances(spark):
    out = K.with_store_partitions(metric_table(spark, SF_SMALL)).hint(
        "rebalance", *K.STORE_PARTITIONS)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(out)


def test_exact_percentile_avoids_single_task_percentile(spark):
    plan = query_plan(spark, "speed_percentiles")
    assert "percentile(" not in plan.replace("percentile_approx", "")


def test_pivot_is_one_aggregate(spark):
    plan = query_plan(spark, "metrics_pivot")
    # metric table (2 shuffles) + one for the pivot
    assert plan.count("Exchange hashpartitioning") == 3


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_udfs(spark, key):
    plan = query_plan(spark, key)
    assert not re.search("(BatchEval|ArrowEval|MapInArrow|MapInPandas|FlatMapGroups)", plan)


def test_cluster_conf_sizes_partitions():
    from transitlens.session import cluster_conf
    conf = cluster_conf(100 * 2**40, executors=1000, cores_per_executor=8)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // 2 // (256 << 20)
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    stream = cluster_conf(100 * 2**40, executors=1000, cores_per_executor=8,
                          streaming_state=True)
    assert stream["spark.sql.shuffle.partitions"] == "16000"
    assert "RocksDB" in stream["spark.sql.streaming.stateStore.providerClass"]
    small = cluster_conf(2**30, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 24  # 3 per core at minimum


def test_acceleration_window_is_split_by_time_bucket(spark):
    plan = query_plan(spark, "acceleration")
    row_windows = [line for line in plan.splitlines()
                   if "Window [lag(" in line]
    assert row_windows and all("_bucket" in line.split("windowspecdefinition(")[1]
                               for line in row_windows)
    # the only per-vehicle window runs over one row per (vehicle, bucket)
    lead = [line for line in plan.splitlines() if "Window [lead(" in line]
    assert len(lead) == 1
