"""Metrics the reference's design documents announce (labelled extensions):
percentiles, network-level windows, downsampling, retention, range
validation, acceleration, punctuality, multi-route comparison, delay alerts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlens.functions.columns import all_of
from transitlens.operators.windows import GROUP_KEYS, metric_aggs, window_metrics
from transitlens.schema import TUMBLING_LABEL
from transitlens.session import checkpoint_root


#: Cells that a percentile's bracket is cut into.
CELLS = 1024


def speed_percentiles(positions: DataFrame, probs=(0.5, 0.95), exact: bool = True,
                      accuracy: int = 10_000, keys: list[str] | None = None) -> DataFrame:
    """Median / 95th percentile of speed and delay per route and direction.

    ``exact`` gives the linearly interpolated percentile (as ``quantile_cont``)
    through ``exact_percentiles``, which never gathers a group's values in one
    task; ``exact=False`` returns the quantile summary's values directly.
    """
    keys = GROUP_KEYS if keys is None else keys
    values = ["speed", "delay"]
    order = [_pname(c, p) for p in probs for c in values]
    if exact:
        return exact_percentiles(positions, keys, values, probs, accuracy).select(*keys, *order)
    agg = positions.groupBy(*keys).agg(*[
        F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(f"_q_{c}")
        for c in values])
    return agg.select(*keys, *[F.col(f"_q_{c}")[i].alias(_pname(c, p))
                               for i, p in enumerate(probs) for c in values]).select(*keys, *order)


def _pname(col: str, p: float) -> str:
    return f"{col}_p{int(round(p * 100))}"


def exact_percentiles(df: DataFrame, keys: list[str], values, probs,
                      accuracy: int = 10_000, grid_size: int = 2048) -> DataFrame:
    """Exact interpolated percentiles per group, without one task per group.

    Spark's ``percentile`` merges a value → count map per group in a single
    task, unbounded for a hot group with continuous values. Instead, for all
    ``values`` columns and ``probs`` at once:

    A. per group: non-null counts and a deterministic quantile summary per
       column (``percentile_approx`` on a fixed rank grid, rank error <=
       n/accuracy); the grid entries just outside the target ranks floor/ceil
       of p(n-1) bracket the exact order statistics;
    B. one pass tags every row per (column, probability) as "below the
       bracket" or as its value when inside; one hash aggregate counts per
       (group, column, probability, value) (ties collapse; about
       2n(2/accuracy + 1/grid) values per bracket);
    C. ranks in two levels: a bracket is cut into ``CELLS`` cells of equal
       width, a running sum over a bracket's cells (the "below" bucket comes
       first) says which cells hold the target ranks, and only the values of
       these are ranked; no task holds a whole bracket. The values at both
       target ranks are interpolated as ``quantile_cont``.

    Rows meet their group's brackets (checkpointed: fixed for the whole job)
    through one null-safe equi-join on the keys (one row per group; AQE splits
    a skewed group's partition). Every group has a row in the result, groups
    with null keys or without a value included. A bracket that missed its rank
    raises an error; the summary's error bound is a guarantee, so with the
    margin used this does not happen.
    """
    values = [values] if isinstance(values, str) else list(values)
    probs = list(probs)
    margin = 2.0 / accuracy + 1.0 / grid_size
    base = df.select(*keys, *[F.col(c).cast("double").alias(f"_v{j}")
                              for j, c in enumerate(values)])
    grid = [r / grid_size for r in range(grid_size + 1)]
    stats_aggs = []
    for j in range(len(values)):
        ok = F.col(f"_v{j}").isNotNull() & ~F.isnan(f"_v{j}")
        stats_aggs += [F.count_if(ok).alias(f"_n{j}"),
                       F.percentile_approx(F.when(ok, F.col(f"_v{j}")), grid, accuracy)
                       .alias(f"_grid{j}")]
    stats = base.groupBy(*keys).agg(*stats_aggs)

    def grid_at(j, rank_fraction, round_up):
        idx = F.ceil(rank_fraction * grid_size) if round_up \
            else F.floor(rank_fraction * grid_size)
        idx = F.least(F.greatest(idx, F.lit(0)), F.lit(grid_size)).cast("int")
        return F.element_at(F.col(f"_grid{j}"), idx + 1)

    cols, pairs = [], []
    for j in range(len(values)):
        n = F.col(f"_n{j}")
        for i, p in enumerate(probs):
            tag = f"{j}_{i}"
            x = F.lit(float(p)) * (n - 1)
            cols += [x.alias(f"_x{tag}"),
                     grid_at(j, F.floor(x) / n - margin, False).alias(f"_lo{tag}"),
                     grid_at(j, (F.ceil(x) + 1) / n + margin, True).alias(f"_hi{tag}")]
            pairs.append((j, i, tag))
    # Pin the brackets: the summary's merge order can vary between runs, so a
    # recomputation after a lost shuffle could hand rows of one group other
    # brackets. A reliable checkpoint (one small row per group, written to the
    # shared checkpoint folder) fixes them for every task of the job.
    checkpoint_root(df.sparkSession)
    counted = [F.col(f"_n{j}") for j in range(len(values))]
    brackets = stats.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *counted, *cols).checkpoint(eager=True)

    def same_group(left: str):
        return all_of([F.col(f"{left}{k}").eqNullSafe(F.col(f"_k_{k}")) for k in keys])

    rows = base.join(brackets, same_group(""))

    def tag_for(j, i, tag):
        v = F.col(f"_v{j}")

        lo, hi = F.col(f"_lo{tag}"), F.col(f"_hi{tag}")
        width = hi - lo
        cell = F.when((width > 0) & (width < float("inf")), F.least(F.floor((v - lo) / width * CELLS), F.lit(CELLS - 1))).otherwise(0)

        def entry(val, at):
            return F.struct(F.lit(j).alias("c"), F.lit(i).alias("p"),
                            F.col(f"_x{tag}").alias("x"), at.cast("int").alias("cell"), val.alias("v"))

        return (F.when(v.isNull() | F.isnan(v), F.lit(None))
                .when(v < lo, entry(F.lit(None).cast("double"), F.lit(-1)))
                .when(v <= hi, entry(v, cell)))

    tags = F.array(*[tag_for(j, i, tag) for j, i, tag in pairs])
    bracket = [*keys, "_c_ix", "_p", "_x"]
    counts = (rows.select(*keys, F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("t"))
              .groupBy(*keys, F.col("t.c").alias("_c_ix"), F.col("t.p").alias("_p"),
                       F.col("t.x").alias("_x"), F.col("t.cell").alias("_cell"), F.col("t.v").alias("_val"))
              .agg(F.count(F.lit(1)).alias("_cnt")))
    low, high = F.floor("_x"), F.ceil("_x")

    def holds(r, first, n):
        return (F.col(first) <= r) & (r < F.col(first) + F.col(n))

    cells = counts.groupBy(*bracket, "_cell").agg(F.sum("_cnt").alias("_held"))
    cells = cells.withColumn("_before", F.sum("_held").over(Window.partitionBy(*bracket).orderBy("_cell")) - F.col("_held"))
    cells = cells.filter((F.col("_cell") >= 0) & (holds(low, "_before", "_held") | holds(high, "_before", "_held")))
    cells = cells.select(*[F.col(c).alias(f"_w{c}") for c in [*bracket, "_cell"]], "_before")
    same_cell = all_of([F.col(c).eqNullSafe(F.col(f"_w{c}")) for c in [*bracket, "_cell"]])
    w = Window.partitionBy(*bracket, "_cell").orderBy("_val")
    ranked = counts.join(cells, same_cell).withColumn("_first", F.col("_before") + F.sum("_cnt").over(w) - F.col("_cnt"))

    def value_at(r):
        return F.max(F.when(holds(r, "_first", "_cnt"), F.col("_val")))

    picked = ranked.groupBy(*keys, "_c_ix", "_p").agg(
        F.first("_x").alias("_x"), value_at(low).alias("_vlo"), value_at(high).alias("_vhi"))
    interp = F.col("_vlo") + (F.col("_x") - F.floor("_x")) * (F.col("_vhi") - F.col("_vlo"))
    found = picked.groupBy(*[F.col(k).alias(f"_f_{k}") for k in keys]).agg(*[
        F.max(F.when((F.col("_c_ix") == j) & (F.col("_p") == i), interp))
        .alias(f"_r{j}_{i}") for j, i, _ in pairs])
    joined = brackets.join(found, same_group("_f_"), "left")
    missed = F.raise_error(F.lit("a percentile lies outside its bracket")).cast("double")
    return joined.select(*[F.col(f"_k_{k}").alias(k) for k in keys], *[
        F.when(F.col(f"_r{j}_{i}").isNull() & (F.col(f"_n{j}") > 0), missed)
        .otherwise(F.col(f"_r{j}_{i}")).alias(_pname(values[j], probs[i])) for j, i, _ in pairs])


def pane_sketches(positions: DataFrame, pane: str = "10 seconds", k: int = 400, keys: list[str] | None = None,
                  values: tuple[str, ...] = ("speed", "delay")) -> DataFrame:
    """One mergeable KLL sketch and the number of values per pane, group and column.

    A sketch of ``k`` has a rank error of about 2 / k whatever goes into it, so
    that panes can be kept instead of messages and merged to any window later.
    """
    keys = GROUP_KEYS if keys is None else keys
    aggs = []
    for c in values:
        v = F.col(c).cast("double")
        v = F.when(~F.isnan(v), v)
        aggs += [F.count(v).alias(f"{c}_n"), F.kll_sketch_agg_double(v, k).alias(f"{c}_sketch")]
    return (positions.groupBy(F.window("event_time", pane).alias("window"), *keys).agg(*aggs)
            .select(F.col("window.start").alias("pane_start"), *keys, *[f"{c}_{x}" for c in values for x in ("n", "sketch")]))


def merged_percentiles(panes: DataFrame, length: str, slide: str | None = None, probs=(0.5, 0.95), keys: list[str] | None = None,
                       values: tuple[str, ...] = ("speed", "delay")) -> DataFrame:
    """Percentiles of windows from the sketches of their panes (whole multiples of a pane); null without a value."""
    keys = GROUP_KEYS if keys is None else keys
    window = F.window("pane_start", length, slide) if slide else F.window("pane_start", length)
    aggs = [a for c in values for a in (F.sum(f"{c}_n").alias(f"{c}_n"), F.kll_merge_agg_double(f"{c}_sketch").alias(f"{c}_sketch"))]
    merged = panes.groupBy(window.alias("window"), *keys).agg(*aggs)
    return merged.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *[f"{c}_n" for c in values],
        *[F.when(F.col(f"{c}_n") > 0, F.kll_sketch_get_quantile_double(f"{c}_sketch", F.lit(float(p)))).alias(_pname(c, p))
          for p in probs for c in values])


def metrics_by_level(positions: DataFrame, length: str = "1 hour", sketch_lg_k: int = 12) -> DataFrame:
    """The six window aggregates per route and direction, per route and for the network, from one scan.

    Messages are aggregated once, to mergeable partials per window, route and
    direction; grouping sets over these few rows give the levels. Distinct
    vehicles are merged HLL sketches, since a vehicle can serve several routes.
    ``level`` tells a missing key from one that the level doesn't have.
    """
    partial = positions.groupBy(F.window("event_time", length).alias("window"), *GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("vehicle_id", sketch_lg_k).alias("vehicles"),
        F.sum("speed").alias("speed"), F.count("speed").alias("speed_n"), F.sum("delay").alias("delay"), F.count("delay").alias("delay_n"),
        F.min("delay").alias("low"), F.max("delay").alias("high"))
    route, direction = (F.col(k) for k in GROUP_KEYS)
    window = F.col("window")
    levels = partial.groupingSets([[window, route, direction], [window, route], [window]], window, route, direction).agg(
        F.grouping_id().alias("missing"), F.sum("n").alias("vehicle_count"),
        F.hll_sketch_estimate(F.hll_union_agg("vehicles")).alias("active_vehicles"),
        F.try_divide(F.sum("speed"), F.sum("speed_n")).alias("avg_speed"), F.try_divide(F.sum("delay"), F.sum("delay_n")).alias("avg_delay"),
        F.min("low").alias("min_delay"), F.max("high").alias("max_delay"))
    level = F.when(F.col("missing") == 0, "route_direction").when(F.col("missing") == 1, "route").otherwise("network")
    return levels.select(level.alias("level"), F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                         *GROUP_KEYS, "vehicle_count", "active_vehicles", "avg_speed", "avg_delay", "min_delay", "max_delay")


def network_metrics(positions: DataFrame, length: str = "1 hour", exact: bool = True) -> DataFrame:
    """The six window aggregates over all routes together (no route key)."""
    agg = positions.groupBy(F.window("event_time", length).alias("window")).agg(
        *metric_aggs(exact))
    return agg.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"),
                      "vehicle_count", "active_vehicles", "avg_speed", "avg_delay",
                      "min_delay", "max_delay")


def downsample(metric_rows: DataFrame, interval: str = "1 hour",
               window_type: str = TUMBLING_LABEL) -> DataFrame:
    """Re-aggregate fine tumbling rows to a coarser interval.

    Counts add up, bounds take min/max, and each mean is weighted by the
    number of values behind it (``speed_n``, ``delay_n``, from
    ``window_metrics(counts=True)``): a message without a speed counts as a
    message but not towards the mean speed. Rows are bucketed by
    ``window_start``, so a fine window lands in the interval that contains it.
    Distinct counts are not additive and are left out.
    """
    rows = metric_rows.filter(F.col("window_type") == F.lit(window_type))
    w = F.window("window_start", interval)

    def mean(field: str, n: str) -> Column:
        return F.try_divide(F.sum(F.col(field) * F.col(n)), F.sum(n)).alias(field)

    agg = rows.groupBy(w.alias("window"), *GROUP_KEYS).agg(
        F.sum("vehicle_count").alias("vehicle_count"),
        mean("avg_speed", "speed_n"), mean("avg_delay", "delay_n"),
        F.min("min_delay").alias("min_delay"), F.max("max_delay").alias("max_delay"),
        F.count(F.lit(1)).alias("source_rows"))
    return agg.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), *GROUP_KEYS,
                      "vehicle_count", "avg_speed", "avg_delay", "min_delay", "max_delay",
                      "source_rows")


def retention(metric_rows: DataFrame, keep_from: Column, time_col: str = "window_end") -> DataFrame:
    """Rows still inside the retention period (``time_col >= keep_from``).

    On the partitioned store the bound on the date prunes whole folders.
    """
    kept = F.col(time_col) >= keep_from
    if "window_date" in metric_rows.columns:
        kept &= F.col("window_date") >= F.to_date(keep_from)
    return metric_rows.filter(kept)


# Fixed validation ranges (name, column, low, high), inclusive bounds.
DEFAULT_RANGES = [("speed_out_of_range", "speed", 0.0, 100.0),
                  ("delay_out_of_range", "delay", -40, 40)]


def with_range_checks(positions: DataFrame, ranges=None) -> DataFrame:
    """Adds ``reject_reasons``: every violated range (empty array = valid)."""
    ranges = DEFAULT_RANGES if ranges is None else ranges
    checks = [F.when(~F.col(c).between(lo, hi), F.lit(name)) for name, c, lo, hi in ranges]
    return positions.withColumn("reject_reasons",
                                F.filter(F.array(*checks), lambda x: x.isNotNull()))


def range_validation(positions: DataFrame, ranges=None) -> DataFrame:
    """Row count per violated range, plus the count of valid rows."""
    checked = with_range_checks(positions, ranges)
    reasons = checked.select(F.explode_outer("reject_reasons").alias("reason"))
    return (reasons.select(F.coalesce("reason", F.lit("valid")).alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("rows")))


def acceleration(positions: DataFrame, bucket: str = "1 hour", vehicle: str = "vehicle_id",
                 order: tuple[str, ...] = ("event_time", "event_id"), keep: tuple[str, ...] = ()) -> DataFrame:
    """Per vehicle: (speed - previous speed) / seconds since the previous message.

    Null for a vehicle's first message and when two messages share a time.
    A vehicle sending a large share of all rows must not land in one task, so
    the lag runs per (vehicle, time bucket); the first row of each bucket gets
    its predecessor from a carry row: the last row of the vehicle's previous
    non-empty bucket, found by a small aggregate (one row per vehicle and
    bucket) and unioned in; no join, no global sort. ``keep`` names further
    columns of the result.
    """
    t, tie = order
    rows = positions.select(vehicle, t, tie, "speed", *keep,
                            F.window(t, bucket).getField("start").alias("_bucket"),
                            F.lit(False).alias("_carry"))
    # One orderable number for (time, tie), so that the aggregate stays a hash aggregate.
    newest = (F.unix_micros(F.col(t).cast("timestamp")).cast("decimal(18,0)") * F.lit(str(10**19)).cast("decimal(20,0)")
              + F.col(tie).cast("decimal(19,0)")).cast("decimal(38,0)")
    last = rows.withColumn("_order", newest).groupBy(vehicle, "_bucket").agg(
        *[F.max_by(c, "_order").alias(f"_last_{c}") for c in (t, tie, "speed")])
    nxt = Window.partitionBy(vehicle).orderBy("_bucket")
    carry = (last.withColumn("_next", F.lead("_bucket").over(nxt))
             .filter(F.col("_next").isNotNull())
             .select(vehicle, *[F.col(f"_last_{c}").alias(c) for c in (t, tie, "speed")],
                     F.col("_next").alias("_bucket"), F.lit(True).alias("_carry")))
    both = rows.unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(vehicle, "_bucket").orderBy(t, tie)
    prev_speed = F.lag("speed").over(w)
    prev_t = F.lag(t).over(w)
    dt_s = (F.unix_micros(F.col(t).cast("timestamp"))
            - F.unix_micros(prev_t.cast("timestamp"))) / F.lit(1_000_000.0)
    acc = F.try_divide(F.col("speed") - prev_speed, F.when(dt_s != 0, dt_s))
    return (both.withColumn("acceleration", acc).filter(~F.col("_carry"))
            .select(tie, vehicle, t, "speed", "acceleration", *keep))


def punctuality(positions: DataFrame, threshold_s: int = 20,
                keys: list[str] | None = None) -> DataFrame:
    """Share of messages with |delay| <= threshold, per route and direction."""
    keys = GROUP_KEYS if keys is None else keys
    on_time = F.abs(F.col("delay")) <= threshold_s
    return positions.groupBy(*keys).agg(
        F.avg(on_time.cast("double")).alias("on_time_share"),
        F.count(F.lit(1)).alias("messages"))


def route_comparison(positions: DataFrame, routes: list[str], length: str = "1 day",
                     value: str = "speed") -> DataFrame:
    """Mean ``value`` per time window, one column per compared route.

    The route list is explicit, and each route column is a conditional mean,
    so the pivot is one partial/final aggregate (no value-discovery job, no
    second shuffle as with ``groupBy().pivot()``).
    """
    return (positions.filter(F.col("route").isin(routes))
            .groupBy(F.window("event_time", length).getField("start").alias("window_start"))
            .agg(*[F.avg(F.when(F.col("route") == F.lit(r), F.col(value))).alias(r)
                   for r in routes]))


def delay_alerts(positions: DataFrame, threshold_s: float = 2.0, length: str = "1 day") -> DataFrame:
    """Window metric rows whose mean delay is above the threshold."""
    rows = window_metrics(positions, length, label=f"tumbling_{length.replace(' ', '')}")
    return rows.filter(F.col("avg_delay") > threshold_s)
