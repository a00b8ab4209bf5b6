"""Event-time window metrics per (window, route, direction).

Six aggregates per group: message count (named ``vehicle_count``, it counts
messages), distinct vehicles, mean speed, mean delay, min and max delay.

Plans:

* ``window_metrics`` is the reference form: ``window()`` (an Expand for
  sliding windows) followed by one hash aggregate with a map-side partial
  step, so a busy route is combined before the shuffle. With ``exact=True``
  the distinct count uses Spark's single-distinct plan (partial aggregation on
  the group key plus ``vehicle_id``, which also spreads a hot vehicle across
  windows); ``exact=False`` keeps an HLL++ sketch per group and works in
  streaming aggregations.
* ``sliding_from_panes`` shares work between overlapping windows: aggregate
  each slide-length pane once, with mergeable partial states (count, sums,
  min, max; per vehicle for the exact distinct count, or an HLL sketch),
  then fan each pane out to the windows covering it and merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlens.schema import METRIC_COLUMNS, SLIDING_LABEL, TUMBLING_LABEL

GROUP_KEYS = ["route", "direction"]


def _seconds(interval: str) -> int:
    """Interval text such as '10 seconds' or '1 hour' to whole seconds."""
    amount, unit = interval.strip().split(None, 1)
    unit = unit.lower().rstrip("s")
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit]
    return int(amount) * scale


def metric_aggs(exact: bool = True, vehicle: str = "vehicle_id",
                rsd: float | None = None, sketch_lg_k: int | None = None,
                counts: bool = False) -> list[Column]:
    """The six metric aggregates. Distinct vehicles: exact (``exact=True``),
    HLL++ (``approx_count_distinct``, optional ``rsd``), or, with
    ``sketch_lg_k``, a DataSketches HLL sketch (mergeable, compact for small
    groups: the smaller streaming state of the two approximate forms).
    ``counts`` adds the numbers behind the means, ``speed_n`` and ``delay_n``."""
    if exact:
        distinct = F.count_distinct(F.col(vehicle))
    elif sketch_lg_k is not None:
        distinct = F.hll_sketch_estimate(F.hll_sketch_agg(F.col(vehicle), sketch_lg_k))
    elif rsd is None:
        distinct = F.approx_count_distinct(F.col(vehicle))
    else:
        distinct = F.approx_count_distinct(F.col(vehicle), rsd)
    return [
        F.count(F.lit(1)).alias("vehicle_count"),
        distinct.alias("active_vehicles"),
        F.avg("speed").alias("avg_speed"),
        F.avg("delay").alias("avg_delay"),
        F.min("delay").alias("min_delay"),
        F.max("delay").alias("max_delay"),
        *([F.count("speed").alias("speed_n"), F.count("delay").alias("delay_n")] if counts else []),
    ]


def window_metrics(positions: DataFrame, length: str = "10 seconds", slide: str | None = None,
                   label: str = TUMBLING_LABEL, exact: bool = True,
                   time_col: str = "event_time", keys: list[str] | None = None,
                   counts: bool = False) -> DataFrame:
    """Metric rows for one window kind (tumbling when ``slide`` is None).

    ``counts`` adds the numbers behind the means, which ``downsample`` needs."""
    keys = GROUP_KEYS if keys is None else keys
    win = F.window(time_col, length, slide) if slide else F.window(time_col, length)
    agg = positions.groupBy(win.alias("window"), *keys).agg(*metric_aggs(exact, counts=counts))
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        F.lit(label).alias("window_type"),
        "vehicle_count", "active_vehicles", "avg_speed", "avg_delay", "min_delay", "max_delay",
        *(["speed_n", "delay_n"] if counts else []),
    )


def window_spans(time_col: str, specs: list[tuple[str, str, str | None]]) -> Column:
    """Every (window_type, start, end) window containing the row, as an array.

    ``specs`` holds (label, length, slide or None). Starts are epoch-aligned
    multiples of the slide, as with ``window()``; bounds are epoch
    microseconds (the caller converts back after aggregating).
    """
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    spans = []
    for label, length, slide in specs:
        length_us = _seconds(length) * 1_000_000
        slide_us = _seconds(slide) * 1_000_000 if slide else length_us
        if length_us % slide_us:
            raise ValueError("window length must be a multiple of the slide")
        base = micros - F.pmod(micros, F.lit(slide_us))
        for k in range(length_us // slide_us):
            start = base - F.lit(k * slide_us)
            spans.append(F.struct(F.lit(label).alias("window_type"), start.alias("start_us"),
                                  (start + F.lit(length_us)).alias("end_us")))
    return F.array(*spans)


def windowed_metrics(positions: DataFrame, tumbling: str = "10 seconds",
                     sliding: str = "60 seconds", slide: str = "10 seconds",
                     exact: bool = True, tumbling_label: str = TUMBLING_LABEL,
                     sliding_label: str = SLIDING_LABEL,
                     time_col: str = "event_time") -> DataFrame:
    """Tumbling and sliding metric rows together, tagged by window_type.

    Same rows as the union of two ``window_metrics`` calls, but in ONE pass:
    each position is expanded (in the scan's task, no shuffle) into the one
    tumbling and the length/slide sliding windows containing it, and a single
    aggregate keyed by (window_type, window, route, direction) computes both
    kinds. The source is read and shuffled once instead of twice.
    """
    spans = window_spans(time_col, [(tumbling_label, tumbling, None),
                                    (sliding_label, sliding, slide)])
    rows = positions.filter(F.col(time_col).isNotNull()).select(
        F.explode(spans).alias("w"), *GROUP_KEYS, "vehicle_id", "speed", "delay")
    agg = rows.groupBy(F.col("w.window_type").alias("window_type"),
                       F.col("w.start_us").alias("start_us"), F.col("w.end_us").alias("end_us"),
                       *GROUP_KEYS).agg(*metric_aggs(exact))
    ts_type = dict(positions.dtypes)[time_col]
    bound_type = "timestamp_ntz" if ts_type == "timestamp_ntz" else "timestamp"
    return agg.select(
        F.timestamp_micros("start_us").cast(bound_type).alias("window_start"),
        F.timestamp_micros("end_us").cast(bound_type).alias("window_end"),
        *GROUP_KEYS, "window_type",
        "vehicle_count", "active_vehicles", "avg_speed", "avg_delay", "min_delay", "max_delay",
    ).select(*METRIC_COLUMNS)


def tumbling_nonnull(positions: DataFrame, length: str = "1 day") -> DataFrame:
    """Non-null count next to the row count: ``count(speed)`` vs ``count(*)``."""
    win = F.window("event_time", length)
    return (positions.groupBy(win.alias("window"), *GROUP_KEYS)
            .agg(F.count(F.lit(1)).alias("vehicle_count"),
                 F.count("speed").alias("speed_count"),
                 F.avg("speed").alias("avg_speed"))
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), *GROUP_KEYS,
                    "vehicle_count", "speed_count", "avg_speed"))


def _partials(*extra) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"),
            F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_n"),
            F.sum("delay").alias("delay_sum"), F.count("delay").alias("delay_n"),
            F.min("delay").alias("min_delay"), F.max("delay").alias("max_delay"), *extra]


def _merged_partials(*extra) -> list[Column]:
    return [F.sum("n").alias("n"),
            F.sum("speed_sum").alias("speed_sum"), F.sum("speed_n").alias("speed_n"),
            F.sum("delay_sum").alias("delay_sum"), F.sum("delay_n").alias("delay_n"),
            F.min("min_delay").alias("min_delay"), F.max("max_delay").alias("max_delay"), *extra]


def sliding_from_panes(positions: DataFrame, length: str = "60 seconds",
                       slide: str = "10 seconds", label: str = SLIDING_LABEL,
                       time_col: str = "event_time", exact: bool = True,
                       lg_config_k: int = 12) -> DataFrame:
    """Sliding-window metrics by pane sharing (same rows as ``window_metrics``).

    Each slide-length pane is aggregated once into mergeable partials (count,
    sums, non-null counts, min, max), then fanned out to the length/slide
    windows that cover it and merged.

    * ``exact=True``: partials per (pane, route, direction, vehicle); the fan-out
      merges them per (window, ..., vehicle), and counting those rows gives
      the exact distinct vehicles. A vehicle's messages collapse to one row
      per pane before the first shuffle, so the expanded rows number about
      (length/slide) × vehicle-panes rather than (length/slide) × messages.
    * ``exact=False``: partials per (pane, route, direction) with an HLL
      sketch; the second shuffle carries one row per (pane, series, window),
      independent of the number of vehicles. ``active_vehicles`` is then a
      sketch estimate (exact at small cardinalities, within the sketch's
      bound beyond).
    """
    length_s, slide_s = _seconds(length), _seconds(slide)
    if length_s % slide_s:
        raise ValueError("window length must be a multiple of the slide")
    fan_out = length_s // slide_s
    pane = F.window(time_col, slide).getField("start")
    offsets = F.sequence(F.lit(0), F.lit(fan_out - 1))

    def fan(df: DataFrame) -> DataFrame:
        # Pane p belongs to the windows starting at p, p - slide, ..., p - (k-1)*slide.
        shift = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                   (F.col("_k") * slide_s).cast("decimal(18,6)"))
        return (df.select("*", F.explode(offsets).alias("_k"))
                .withColumn("window_start", F.col("pane_start") - shift).drop("_k", "pane_start"))

    if exact:
        per_vehicle = positions.groupBy(pane.alias("pane_start"), *GROUP_KEYS, "vehicle_id") \
            .agg(*_partials())
        per_window_vehicle = fan(per_vehicle).groupBy("window_start", *GROUP_KEYS, "vehicle_id") \
            .agg(*_merged_partials())
        merged = per_window_vehicle.groupBy("window_start", *GROUP_KEYS).agg(
            *_merged_partials(F.count("vehicle_id").alias("active_vehicles")))
    else:
        panes = positions.groupBy(pane.alias("pane_start"), *GROUP_KEYS).agg(
            *_partials(F.hll_sketch_agg("vehicle_id", lg_config_k).alias("sketch")))
        merged = fan(panes).groupBy("window_start", *GROUP_KEYS).agg(*_merged_partials(
            F.hll_sketch_estimate(F.hll_union_agg("sketch", True)).alias("active_vehicles")))
    end = F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                     F.lit(length_s).cast("decimal(18,6)"))
    return merged.select(
        "window_start", end.alias("window_end"), *GROUP_KEYS, F.lit(label).alias("window_type"),
        F.col("n").alias("vehicle_count"), "active_vehicles",
        F.try_divide("speed_sum", "speed_n").alias("avg_speed"),
        F.try_divide("delay_sum", "delay_n").alias("avg_delay"),
        "min_delay", "max_delay")
