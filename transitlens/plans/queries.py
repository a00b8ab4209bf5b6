"""Historical and live questions over the metric table.

Every function takes the wide metric table (``window_start, window_end,
route, direction, window_type`` + six metric fields) and returns a lazy
DataFrame; nothing is collected on the driver. Filters are typed column
literals (never spliced text), so they reach the Parquet scan. On a stored
table (one with ``window_date``) every range on the window end also bounds the
date, so that only the folders of these days are read.

No call cuts rows unless it is given a limit.

Time arguments (``start``, ``end``, ``as_of``) accept a ``datetime`` or a
Column (e.g. ``df.select(F.max(...)).scalar()``, a lazily planned scalar
subquery). "Now" of the reference becomes the explicit ``as_of``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlens.functions.columns import all_of, equals_filters
from transitlens.operators.reshape import pick_latest
from transitlens.schema import METRIC_FIELDS, SERIES_KEYS, SUMMARY_FIELDS

MAX_LIMIT = 10_000
DEFAULT_LOOKBACK = dt.timedelta(hours=24)

RECORD_COLUMNS = ["timestamp", *SERIES_KEYS, *METRIC_FIELDS]


def _lit_time(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        return F.lit(value.replace(tzinfo=None)).cast("timestamp_ntz") if value.tzinfo is None \
            else F.lit(value.astimezone(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
    if isinstance(value, str):
        return F.lit(value).cast("timestamp_ntz")
    raise TypeError(f"unsupported time value: {value!r}")


def _minus(t: Column, delta: dt.timedelta) -> Column:
    micros = int(delta.total_seconds() * 1_000_000)
    return t - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                  F.lit(micros / 1_000_000).cast("decimal(18,6)"))


def time_range(start=None, end=None, as_of=None, lookback: dt.timedelta = DEFAULT_LOOKBACK,
               col: str = "window_end") -> Column:
    """Half-open range on ``col`` with the metrics-call rules.

    both → [start, end); only start → [start, as_of); only end →
    [as_of - lookback, end); neither → [as_of - lookback, as_of). Without
    ``as_of`` the open sides stay open (whole stored history).
    """
    t = F.col(col)
    conds = []
    if start is not None:
        conds.append(t >= _lit_time(start))
    elif as_of is not None:
        conds.append(t >= _minus(_lit_time(as_of), lookback))
    if end is not None:
        conds.append(t < _lit_time(end))
    elif as_of is not None:
        conds.append(t < _lit_time(as_of))
    return all_of(conds)


def in_range(df: DataFrame, start=None, end=None, as_of=None, lookback: dt.timedelta = DEFAULT_LOOKBACK) -> Column:
    """``time_range``, with the same bounds on the date of a stored table."""
    cond = time_range(start, end, as_of, lookback)
    if "window_date" not in df.columns:
        return cond
    low = _lit_time(start) if start is not None else _minus(_lit_time(as_of), lookback) if as_of is not None else None
    high = _lit_time(end) if end is not None else _lit_time(as_of) if as_of is not None else None
    day = F.col("window_date")
    dates = ([day >= F.to_date(low)] if low is not None else []) + ([day <= F.to_date(high)] if high is not None else [])
    return all_of([cond, *dates])


def validate_limit(limit: int | None) -> int | None:
    if limit is None:
        return None
    if not isinstance(limit, int) or not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be an integer in 1..{MAX_LIMIT}, got {limit!r}")
    return limit


def as_records(df: DataFrame) -> DataFrame:
    """Metric rows as API records: time = window_end, missing numbers → 0, tags → ''."""
    return df.select(
        F.col("window_end").alias("timestamp"),
        *[F.coalesce(F.col(k), F.lit("")).alias(k) for k in SERIES_KEYS],
        F.coalesce(F.col("vehicle_count"), F.lit(0)).cast("bigint").alias("vehicle_count"),
        F.coalesce(F.col("active_vehicles"), F.lit(0)).cast("bigint").alias("active_vehicles"),
        F.coalesce(F.col("avg_speed"), F.lit(0.0)).alias("avg_speed"),
        F.coalesce(F.col("avg_delay"), F.lit(0.0)).alias("avg_delay"),
        F.coalesce(F.col("min_delay"), F.lit(0)).cast("int").alias("min_delay"),
        F.coalesce(F.col("max_delay"), F.lit(0)).cast("int").alias("max_delay"),
    )


def latest_per_series(df: DataFrame, n: int, time_col: str = "window_end") -> DataFrame:
    """Newest ``n`` rows of every series (route, direction, window_type).

    ``row_number() <= n`` is planned as a WindowGroupLimit: each task keeps
    only its top ``n`` per series before the shuffle, so a busy series moves
    at most n rows per task.
    """
    w = Window.partitionBy(*SERIES_KEYS).orderBy(F.col(time_col).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def metrics(df: DataFrame, route: str | None = None, direction: str | None = None,
            window_type: str | None = None, start=None, end=None, limit: int | None = None,
            as_of=None, per_series: bool = True) -> DataFrame:
    """Filtered metric records, newest first, ``limit`` per series.

    The limit applies to each series (so up to ``limit`` × series rows can
    return); ``per_series=False`` gives one global newest-``limit`` list.
    Without a limit all records are returned.
    """
    validate_limit(limit)
    sel = df.filter(equals_filters(route=route, direction=direction, window_type=window_type)
                    & in_range(df, start, end, as_of))
    if limit is None:
        return as_records(sel.orderBy(*SERIES_KEYS, F.col("window_end").desc()))
    if per_series:
        return as_records(latest_per_series(sel, limit))
    return latest_global(sel, limit)


def latest_global(df: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` records overall, ties broken by the series key (top-k, no full sort)."""
    validate_limit(n)
    return as_records(df.orderBy(F.col("window_end").desc(), *SERIES_KEYS).limit(n))


def routes(df: DataFrame, start=None, end=None, as_of=None) -> DataFrame:
    """Sorted distinct non-empty routes with data in the range (default: last 24 h)."""
    return (df.filter(in_range(df, start, end, as_of)).select("route")
            .filter(F.col("route").isNotNull() & (F.col("route") != ""))
            .distinct().orderBy("route"))


def series_means(df: DataFrame, route: str | None = None, start=None, end=None,
                 as_of=None) -> DataFrame:
    """Mean of each summary field per series, long form (one row per series and field).

    Aggregated wide first (partial + final hash aggregate), then unpivoted:
    the shuffle carries one partial row per series and task.
    """
    sel = df.filter(equals_filters(route=route) & _stats_range(df, start, end, as_of))
    wide = sel.groupBy(*SERIES_KEYS).agg(*[F.avg(f).alias(f) for f in SUMMARY_FIELDS])
    return wide.unpivot(SERIES_KEYS, SUMMARY_FIELDS, "field", "mean").filter(
        F.col("mean").isNotNull())


def _stats_range(df: DataFrame, start, end, as_of) -> Column:
    # The statistics call applies a range only when both ends are given.
    if start is not None and end is not None:
        return in_range(df, start, end)
    return in_range(df, None, None, as_of)


def route_stats(df: DataFrame, route: str | None = None, start=None, end=None,
                as_of=None) -> DataFrame:
    """Per route: unweighted means over all its metric rows.

    ``total_observations`` keeps the reference's definition (the integer part
    of the mean vehicle count); ``n_rows`` is the actual row count.
    """
    sel = df.filter(equals_filters(route=route) & _stats_range(df, start, end, as_of))
    return (sel.groupBy("route")
            .agg(F.avg("vehicle_count").alias("avg_vehicle_count"),
                 F.avg("avg_speed").alias("avg_speed"),
                 F.avg("avg_delay").alias("avg_delay"),
                 F.count(F.lit(1)).alias("n_rows"))
            .withColumn("total_observations",
                        F.coalesce(F.col("avg_vehicle_count").cast("bigint"), F.lit(0).cast("bigint")))
            .select("route", "total_observations", "avg_vehicle_count", "avg_speed",
                    "avg_delay", "n_rows"))


def summary_stats(df: DataFrame) -> DataFrame:
    """Dashboard summary of a selection: record count and three means (one row)."""
    return df.agg(F.count(F.lit(1)).alias("total_records"),
                  F.avg("vehicle_count").alias("avg_vehicle_count"),
                  F.avg("avg_speed").alias("avg_speed"),
                  F.avg("avg_delay").alias("avg_delay"))


def display_summary(summary: DataFrame) -> DataFrame:
    """Summary as shown on the dashboard: fixed decimals (.1f count and delay,
    .2f speed). Text for display only; Spark rounds half-up."""
    return summary.select(
        F.col("total_records"),
        F.format_string("%.1f", "avg_vehicle_count").alias("avg_vehicle_count"),
        F.format_string("%.2f m/s", "avg_speed").alias("avg_speed"),
        F.format_string("%.1f s", "avg_delay").alias("avg_delay"),
        F.when(F.col("avg_delay") >= 0, F.lit("normal")).otherwise(F.lit("inverse"))
        .alias("delay_color"))


def chart_series(df: DataFrame, time_col: str = "window_end") -> DataFrame:
    """Three plotted series (count, speed, delay) by window type, time ascending.

    ``late`` marks points above the on-time (zero delay) line.
    """
    long = df.select(
        F.col(time_col).alias("window_end"), "window_type",
        (F.col("avg_delay") > 0).alias("late"),
        F.col("vehicle_count").cast("double").alias("vehicle_count"),
        F.col("avg_speed"), F.col("avg_delay"),
    ).unpivot(["window_end", "window_type", "late"], SUMMARY_FIELDS, "metric", "value")
    return long.select("window_end", "window_type", "metric", "value", "late") \
        .orderBy("metric", "window_type", "window_end")


def historical_view(df: DataFrame, route: str, direction: str, as_of,
                    lookback: dt.timedelta = dt.timedelta(days=7),
                    limit: int | None = None) -> DataFrame:
    """Records of one route/direction over the past ``lookback`` before ``as_of``."""
    start = _minus(_lit_time(as_of), lookback)
    return metrics(df, route=route, direction=direction, start=start, end=_lit_time(as_of),
                   limit=limit)


def raw_table(records: DataFrame) -> DataFrame:
    """Record table with the time shown as text (yyyy-MM-dd HH:mm:ss)."""
    return records.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


def live_view(df: DataFrame, route: str | None = None, direction: str | None = None,
              *, tail: int) -> DataFrame:
    """Newest ``tail`` metric messages, then the route/direction filter.

    Values compare as text; an empty selection keeps everything.
    """
    newest = df.orderBy(F.col("window_end").desc(), *SERIES_KEYS).limit(tail)
    return newest.filter(_live_filter(route, direction))


def _live_filter(route, direction) -> Column:
    conds = []
    if route:
        conds.append(F.coalesce(F.col("route").cast("string"), F.lit("")) == F.lit(str(route)))
    if direction:
        conds.append(F.coalesce(F.col("direction").cast("string"), F.lit(""))
                     == F.lit(str(direction)))
    return all_of(conds)


def live_view_counts(df: DataFrame, route: str | None = None, direction: str | None = None,
                     *, tail: int) -> DataFrame:
    """Shown vs. total messages for a live filter, with the summary of the shown ones."""
    newest = df.orderBy(F.col("window_end").desc(), *SERIES_KEYS).limit(tail)
    pred = _live_filter(route, direction)
    return newest.agg(
        F.count_if(pred).alias("shown"), F.count(F.lit(1)).alias("total"),
        F.avg(F.when(pred, F.col("vehicle_count"))).alias("avg_vehicle_count"),
        F.avg(F.when(pred, F.col("avg_speed"))).alias("avg_speed"),
        F.avg(F.when(pred, F.col("avg_delay"))).alias("avg_delay"))


def latest_known(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Last known metric row per series (what the dashboard shows when nothing new came).

    A partial/final aggregate (``max_by`` on window_end, unique per series):
    a busy series is reduced inside each task before the shuffle.
    """
    keys = SERIES_KEYS if keys is None else keys
    return pick_latest(df, keys, "window_end")


AUDIT_SCHEMA = ("timestamp string, service string, event_type string, method string, "
                "path string, client_ip string, response_code int, error string")


def audit_rollup(log_lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Count structured JSON log events by service, event type and response code."""
    rec = F.from_json(F.col(value_col), AUDIT_SCHEMA)
    parsed = log_lines.select(rec.alias("r")).select("r.*").filter(F.col("event_type").isNotNull())
    return (parsed.groupBy("service", "event_type", "response_code")
            .agg(F.count(F.lit(1)).alias("events")))


def select_range(df: DataFrame, route=None, direction=None, window_type=None, start=None,
                 end=None, as_of=None) -> DataFrame:
    return df.filter(equals_filters(route=route, direction=direction, window_type=window_type)
                     & in_range(df, start, end, as_of))
