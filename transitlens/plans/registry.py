"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator key.

Each query reads the driver's tables (or data Spark derives from them) in
full, runs the operator, and ends in ``finalize`` so results compare across
engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from transitlens.functions.columns import vehicle_key
from transitlens.operators import extensions as X
from transitlens.operators import reshape as R
from transitlens.operators import sinks as K
from transitlens.operators import windows as W
from transitlens.operators.decode import decode_positions, metrics_from_messages
from transitlens.operators.rollup import refresh
from transitlens.operators.store import MetricStore
from transitlens.plans import queries as Q
from transitlens.plans.oracles import COMPARED_ROUTES
from transitlens.plans.present import finalize
from transitlens.schema import METRIC_FIELDS, SERIES_KEYS
from transitlens.session import shared_path
from transitlens.sources import files, ingest
from transitlens.sources.adapter import (
    envelope_messages_from_events,
    positions_from_events,
    raw_messages_from_events,
    topic_for,
)
from transitlens.sources.bus import RecordLog, stream_log
from transitlens.sources.readers import read_events, stream_events
from transitlens.streaming import stream as S

LATE_CUTOFF = dt.datetime(2024, 1, 16)
PROCESSED_AT = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)

Query = Callable[[SparkSession, str], DataFrame]


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions_from_events(read_events(spark, sf_dir))


def metric_table(spark: SparkSession, sf_dir: str, exact: bool = True) -> DataFrame:
    """M: 10 s tumbling + 60 s / 10 s sliding metric rows."""
    return W.windowed_metrics(positions(spark, sf_dir), exact=exact)


def load_store(spark: SparkSession, sf_dir: str, path: str) -> MetricStore:
    """M written as a store; its manifest also keeps the newest event's time, observed by the same scan."""
    store, seen = MetricStore(spark, path), Observation()
    feed = positions(spark, sf_dir).observe(seen, F.max("event_time").cast("string").alias("newest_event"))
    store.load(W.windowed_metrics(feed), facts=lambda: dict(seen.get))
    return store


def metric_store(spark: SparkSession, sf_dir: str) -> MetricStore:
    """The date-partitioned store of an input, which is written where there is none yet.

    Its place is named by the input's files, their sizes and times, so that a
    changed input is another store. Historical and live questions read it as
    the reference's API does; only the folders of the asked dates are opened.
    """
    path = shared_path(spark, "metric_store", files.fingerprint(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    store = MetricStore(spark, path)
    return store if store.manifest().version else load_store(spark, sf_dir, path)


def stored_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_store(spark, sf_dir).read()


def q_tumbling_metrics(spark, sf_dir):
    return finalize(W.window_metrics(positions(spark, sf_dir), "10 seconds"))


def q_sliding_metrics(spark, sf_dir):
    return finalize(W.window_metrics(positions(spark, sf_dir), "60 seconds", "10 seconds",
                                     label="sliding_60s"))


def q_windowed_metrics(spark, sf_dir):
    return finalize(metric_table(spark, sf_dir))


def q_windowed_metrics_1h(spark, sf_dir):
    return finalize(W.windowed_metrics(positions(spark, sf_dir), "1 hour", "6 hours", "1 hour",
                                       tumbling_label="tumbling_1h", sliding_label="sliding_6h"))


def q_tumbling_nonnull(spark, sf_dir):
    pos = positions(spark, sf_dir).withColumn(
        "speed", F.when(F.col("event_id") % 7 != 0, F.col("speed")))
    return finalize(W.tumbling_nonnull(pos, "1 day"))


def q_sliding_from_panes(spark, sf_dir):
    return finalize(W.sliding_from_panes(positions(spark, sf_dir), "60 seconds", "10 seconds"))


def q_decode_positions(spark, sf_dir):
    return finalize(decode_positions(envelope_messages_from_events(read_events(spark, sf_dir))))


def raw_messages(spark, sf_dir):
    return raw_messages_from_events(read_events(spark, sf_dir))


ENVELOPE_CHECK_SCHEMA = ("mqtt_topic string, received_at double, schema_version int, "
                         "payload struct<VP: struct<desi string, dir string, veh bigint, "
                         "tst string, spd double, dl int>>")


def q_ingest_envelope(spark, sf_dir):
    """Envelopes of every good message, read back with one JSON parse per record."""
    records = ingest.envelope(raw_messages(spark, sf_dir))
    env = F.from_json(F.col("value"), ENVELOPE_CHECK_SCHEMA)
    vp = env.getField("payload").getField("VP")
    return finalize(records.select(
        env.getField("mqtt_topic").alias("mqtt_topic"),
        F.col("key"),
        vp.getField("desi").alias("route"),
        vp.getField("dir").alias("direction"),
        vp.getField("veh").alias("vehicle_id"),
        vp.getField("tst").alias("tst"),
        vp.getField("spd").alias("speed"),
        vp.getField("dl").alias("delay"),
        env.getField("received_at").alias("received_at"),
        env.getField("schema_version").alias("schema_version"),
    ))


def q_vehicle_key(spark, sf_dir):
    pos = positions(spark, sf_dir)
    eid = F.col("event_id")
    topic = topic_for(eid, F.col("vehicle_id"), F.col("route"), F.col("direction"),
                      with_marker=(eid % 10 != 0), empty_vehicle=(eid % 11 == 0))
    return pos.select(eid, topic.alias("topic")).withColumn("key", vehicle_key(F.col("topic")))


def q_ingest_rejects(spark, sf_dir):
    return finalize(ingest.rejects(raw_messages(spark, sf_dir))
                    .select("event_id", "topic", "reject_reason", "received_at"))


def q_ingest_stats(spark, sf_dir):
    return finalize(ingest.ingest_stats(raw_messages(spark, sf_dir)))


def q_ingest_stats_60s(spark, sf_dir):
    """Ingest statistics per 60-second reporting interval of the receive time."""
    interval = F.window(F.timestamp_seconds("received_at"), "60 seconds")
    stats = ingest.ingest_stats(raw_messages(spark, sf_dir), interval.alias("interval"))
    return finalize(stats.select(F.col("interval.start").alias("interval_start"),
                                 F.col("interval.end").alias("interval_end"),
                                 "messages_processed", "errors", "success_rate"))


def q_topic_filter(spark, sf_dir):
    return ingest.filter_topics(raw_messages(spark, sf_dir), "/hfp/v2/journey/+/vp/bus/#") \
        .select("event_id", "topic")


def as_of(spark, sf_dir):
    """Reference "now": the newest event time, which the store's manifest keeps."""
    return F.lit(metric_store(spark, sf_dir).manifest().facts["newest_event"]).cast("timestamp_ntz")


def q_metrics_query(spark, sf_dir):
    start, end = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)
    return finalize(Q.metrics(stored_metrics(spark, sf_dir), route="click", direction="1", window_type="sliding_60s",
                              start=start, end=end, limit=100))


def q_metrics_latest_n(spark, sf_dir):
    return finalize(Q.metrics(stored_metrics(spark, sf_dir), limit=5))


def q_metrics_latest_global(spark, sf_dir):
    return finalize(Q.metrics(metric_store(spark, sf_dir).newest(100), limit=100, per_series=False))


def q_routes_list(spark, sf_dir):
    return Q.routes(stored_metrics(spark, sf_dir), as_of=as_of(spark, sf_dir))


def q_series_means(spark, sf_dir):
    return finalize(Q.series_means(stored_metrics(spark, sf_dir)))


def q_route_stats(spark, sf_dir):
    return finalize(Q.route_stats(stored_metrics(spark, sf_dir)))


def q_summary_stats(spark, sf_dir):
    return finalize(Q.summary_stats(stored_metrics(spark, sf_dir)))


def q_chart_series(spark, sf_dir):
    sel = Q.select_range(stored_metrics(spark, sf_dir), route="view", direction="2")
    return finalize(Q.chart_series(sel))


def historical(spark, sf_dir):
    now = as_of(spark, sf_dir)
    return Q.historical_view(stored_metrics(spark, sf_dir), route="error", direction="1", as_of=now,
                             lookback=dt.timedelta(days=7), limit=1000)


def q_historical_view(spark, sf_dir):
    return finalize(historical(spark, sf_dir))


def q_raw_table(spark, sf_dir):
    return finalize(Q.raw_table(historical(spark, sf_dir)))


def q_live_view(spark, sf_dir):
    return finalize(Q.live_view(metric_store(spark, sf_dir).newest(100), route="click", tail=100).drop("window_date"))


def metric_bus(spark, sf_dir):
    """The topic of published metric messages of an input, in time order; published where there is none yet."""
    root = shared_path(spark, "metric_bus", files.fingerprint(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    log = RecordLog(spark, root, "metrics")
    if not log.ends():
        rows = K.with_processed_at(stored_metrics(spark, sf_dir))
        order = ["window_end", *SERIES_KEYS]
        log.publish(K.metrics_json(rows, carry=order), 1, [F.asc("window_end"), *(F.desc(k) for k in SERIES_KEYS)])
    return log


def q_live_view_bus(spark, sf_dir):
    """Live view over the bus: one poll of at most 100 messages, from the group's stored position."""
    log = metric_bus(spark, sf_dir)
    log.commit("dashboard", log.back(100))  # a consumer that joins reads the newest messages
    messages, _ = log.poll(log.position("dashboard"), 100)
    return finalize(Q.live_view(metrics_from_messages(messages).drop("processed_at"), route="click", tail=100))


def q_live_view_counts(spark, sf_dir):
    return finalize(Q.live_view_counts(metric_store(spark, sf_dir).newest(100), route="click", tail=100))


def q_latest_known(spark, sf_dir):
    return finalize(Q.latest_known(stored_metrics(spark, sf_dir).drop("window_date")))


def audit_log_lines(spark, sf_dir):
    """One structured JSON log line per event (service, event type, response code)."""
    ev = read_events(spark, sf_dir)
    eid = F.col("event_id")
    codes = F.array(F.lit(200), F.lit(401), F.lit(403), F.lit(429))
    return ev.select(F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.col("event_type").alias("service"),
        F.when(eid % 2 == 0, F.lit("api_request")).otherwise(F.lit("batch_written"))
        .alias("event_type"),
        F.element_at(codes, (eid % 4 + 1).cast("int")).alias("response_code"),
    )).alias("value"))


def q_audit_rollup(spark, sf_dir):
    return Q.audit_rollup(audit_log_lines(spark, sf_dir))


def q_metrics_long(spark, sf_dir):
    return finalize(R.metrics_long(metric_table(spark, sf_dir)))


def q_metrics_pivot(spark, sf_dir):
    return finalize(R.metrics_pivot(R.metrics_long(metric_table(spark, sf_dir))))


def q_metrics_upsert(spark, sf_dir):
    """Three emitted versions of every window (batch 0..2, count raised by the
    batch id) collapse to the newest one."""
    m = metric_table(spark, sf_dir)
    changelog = (m.withColumn("batch_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
                 .withColumn("vehicle_count", F.col("vehicle_count") + F.col("batch_id")))
    return finalize(R.upsert_latest(changelog))


def q_metrics_store(spark, sf_dir):
    """Write M to a partitioned store of its own (shared folder), read all of it back."""
    return finalize(load_store(spark, sf_dir, shared_path(spark, "metrics_store", unique=True)).read())


def q_metrics_json(spark, sf_dir):
    """Published messages, each parsed back; the stamp is fixed so that rows compare."""
    stamped = metric_table(spark, sf_dir).withColumn("processed_at", F.lit(PROCESSED_AT).cast("timestamp"))
    return finalize(metrics_from_messages(K.metrics_json(stamped)))


def q_line_protocol(spark, sf_dir):
    """Points with odd values (null and empty tags, NaN and infinite fields, text to escape), parsed back."""
    m = metric_table(spark, sf_dir)
    odd = F.pmod(F.unix_seconds(F.col("window_end").cast("timestamp")), F.lit(700))
    m = m.withColumns({
        "route": F.when(odd == 0, F.lit(None)).when(odd == 10, F.lit("")).when(odd == 20, F.lit("a b,c=d\\")).otherwise(F.col("route")),
        "avg_speed": F.when(odd == 30, F.lit(float("nan"))).when(odd == 40, F.lit(float("inf"))).otherwise(F.col("avg_speed"))})
    return finalize(K.parse_points(K.line_protocol(m)))


def stream_positions(spark, sf_dir):
    return S.positions_from_event_stream(stream_events(spark, sf_dir))


def _feed(spark, sf_dir, name, parts, start):
    """The reference's stream over several arrivals: envelopes, decoding, watermark, all six
    metrics of both window kinds, into what ``start`` (metrics, output folder, checkpoint) starts.

    Each of ``parts`` (conditions that together hold for every event) is added
    to the feed of bus records, and the query runs to its end and stops; the
    next run resumes from the checkpoint. Returns the output folder.
    """
    events = read_events(spark, sf_dir)
    root = shared_path(spark, name, unique=True)
    feed, out = f"{root}/feed", f"{root}/out"
    checkpoint = S.checkpoint_for(spark, name, unique=True)
    for part in parts:
        envelope_messages_from_events(events.filter(part)).select("key", "value").write.mode("append").parquet(feed)
        source = spark.readStream.schema("key string, value string").parquet(feed)
        S.run_to_end(start(S.streaming_metrics(S.event_time_ts(S.positions_from_bus(source))), out, checkpoint))
    return out


def _arrivals(spark, sf_dir, name, parts, append=False):
    """In update mode windows are emitted again as their events arrive; the result is the
    upserted changelog. In append mode it is what the file sink has."""
    start = S.start_files if append else S.start_update
    out = _feed(spark, sf_dir, name, parts, lambda m, path, checkpoint: start(m, path, checkpoint, trigger="availableNow"))
    if append:
        return finalize(spark.read.parquet(out))
    return finalize(R.upsert_latest(S.read_changelog(spark, out)))


def _days(*cuts, column="ts"):
    """Conditions for the stretches of time between cuts."""
    ts = F.col(column)
    bounds = [None, *cuts, None]
    return [(F.lit(True) if a is None else ts >= F.lit(a)) & (F.lit(True) if b is None else ts < F.lit(b))
            for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def q_stream_metrics_update(spark, sf_dir):
    """Update mode over three arrivals; windows across a cut are emitted twice."""
    return _arrivals(spark, sf_dir, "stream_update", _days(dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21)))


def q_stream_metrics_append(spark, sf_dir):
    """Append mode over two arrivals into a Parquet file sink; only closed windows arrive."""
    return _arrivals(spark, sf_dir, "stream_append", _days(LATE_CUTOFF), append=True)


def q_stream_store(spark, sf_dir):
    """Four arrivals, committed batch by batch to the compacted store; the store is the metric table."""
    cuts = [dt.datetime(2024, 1, d) for d in (8, 15, 22)]
    out = _feed(spark, sf_dir, "stream_store", _days(*cuts), lambda m, path, checkpoint: S.start_store(
        m, MetricStore(spark, path), checkpoint, trigger="availableNow"))
    return finalize(MetricStore(spark, out).read())


def _bus_arrivals(spark, sf_dir, name, parts):
    """(root, topic, publish(part)): envelopes of events go to a bus topic, arrival by arrival."""
    root = shared_path(spark, name, unique=True)
    events, log = read_events(spark, sf_dir), RecordLog(spark, f"{root}/bus", "positions")
    return root, [lambda part=part: log.publish(envelope_messages_from_events(events.filter(part)).select("key", "value"), 4) for part in parts]


def q_stream_bus(spark, sf_dir):
    """The stream from the bus: each arrival is read from the offsets in the checkpoint on, by a query started anew."""
    root, arrivals = _bus_arrivals(spark, sf_dir, "stream_bus", _days(dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21)))
    store, checkpoint = MetricStore(spark, f"{root}/store"), S.checkpoint_for(spark, "stream_bus", unique=True)
    for publish in arrivals:
        publish()
        metrics = S.streaming_metrics(S.event_time_ts(S.positions_from_bus(stream_log(spark, f"{root}/bus", "positions"))))
        S.run_to_end(S.start_store(metrics, store, checkpoint, trigger="availableNow"))
    return finalize(store.read())


def q_stream_counters(spark, sf_dir):
    """One running query with a processing-time trigger: what its batches report, and their stamps.

    Each arrival is published once the one before is done. A batch's report
    has its input rows and, observed on the executors, its emitted rows; its
    stored rows carry its stamp.
    """
    root, arrivals = _bus_arrivals(spark, sf_dir, "stream_counters", _days(dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21)))
    arrivals[0]()
    metrics = S.streaming_metrics(S.event_time_ts(S.positions_from_bus(stream_log(spark, f"{root}/bus", "positions"))), plan="one_read")
    query = S.start_update(K.with_processed_at(S.with_batch_counters(metrics)), f"{root}/out",
                           S.checkpoint_for(spark, "stream_counters", unique=True), trigger="1 second")
    try:
        for publish in arrivals[1:]:
            query.processAllAvailable()
            publish()
        query.processAllAvailable()
        reports = [(p.batchId, p.numInputRows, p.observedMetrics["batch_counters"]["rows"]) for p in query.recentProgress if p.numInputRows]
    finally:
        query.stop()
    stamps = S.read_changelog(spark, f"{root}/out").groupBy("batch_id").agg(
        F.count("*").alias("stored_rows"), F.countDistinct("processed_at").alias("stamps"))
    rows = spark.createDataFrame(reports, "batch_id long, input_rows long, emitted_rows long").join(stamps, "batch_id")
    return rows.select(F.row_number().over(Window.orderBy("batch_id")).cast("bigint").alias("arrival"), "input_rows",
                       "emitted_rows", "stored_rows", "stamps")


def q_stream_multi_sink(spark, sf_dir):
    """One streaming query (single state store) feeding three sinks through
    foreachBatch, over two arrivals. All three are read back: the store, the
    JSON messages and the points, the newest emission of each window."""
    out = _feed(spark, sf_dir, "multi_sink", _days(LATE_CUTOFF), lambda m, path, checkpoint: S.start_multi_sink(
        S.with_batch_counters(m), path, checkpoint, trigger="availableNow", store=MetricStore(spark, f"{path}/metrics")))
    batch = F.col("batch_id").cast("bigint").alias("batch_id")
    text = spark.read.schema("value string, batch_id bigint")
    messages = text.text(f"{out}/json").select("value", batch)
    rows = {
        "store": MetricStore(spark, f"{out}/metrics").read(),
        "json": R.upsert_latest(metrics_from_messages(messages, "batch_id")),
        "points": R.upsert_latest(K.parse_points(text.text(f"{out}/points"), "batch_id").withColumn(
            "window_end", F.timestamp_micros(F.expr("time_ns div 1000")))),
    }
    columns = ["window_end", *SERIES_KEYS, *METRIC_FIELDS]
    parts = [df.select(F.lit(sink).alias("sink"), "window_end", *SERIES_KEYS, *[F.col(f).cast("double").alias(f) for f in METRIC_FIELDS])
             for sink, df in rows.items()]
    return finalize(parts[0].unionByName(parts[1]).unionByName(parts[2]).select("sink", *columns))


def q_stream_acceleration(spark, sf_dir):
    """Four arrivals, the query started anew for each; vehicles' last positions are the state."""
    pos = positions(spark, sf_dir).select("event_id", "vehicle_id", "event_time", "speed")
    root, checkpoint = shared_path(spark, "stream_acceleration", unique=True), S.checkpoint_for(spark, "stream_acceleration", unique=True)
    for part in _days(*[dt.datetime(2024, 1, d) for d in (8, 15, 22)], column="event_time"):
        pos.filter(part).write.mode("append").parquet(f"{root}/feed")
        feed = spark.readStream.schema(pos.schema).parquet(f"{root}/feed")
        S.run_to_end(S.start_acceleration(feed, root, checkpoint, ttl="365 days", trigger="availableNow"))
    return finalize(spark.read.parquet(f"{root}/out").drop("batch_id"))


def q_late_data(spark, sf_dir):
    """Late arrivals are dropped by the watermark.

    Events at or after the cutoff arrive first; the stream runs to its end
    (the watermark advances to the newest event minus one minute) and stops;
    then all earlier events arrive and the stream restarts from its
    checkpoint. They are older than the watermark, so the stored result
    holds only the on-time events' windows.
    """
    before, after = _days(LATE_CUTOFF)
    return _arrivals(spark, sf_dir, "late_data", [after, before])


def q_stream_restart(spark, sf_dir):
    """Restart from the checkpoint keeps offsets and window state: events
    before the cutoff, stop, the rest, restart; the result equals the
    metrics over the whole table (windows spanning the cutoff included)."""
    return _arrivals(spark, sf_dir, "stream_restart", _days(LATE_CUTOFF))


def q_active_vehicles_approx(spark, sf_dir):
    """The exact counts, and for each row whether the sketch-based one is within three standard errors."""
    keys = ["window_start", "window_end", *SERIES_KEYS]
    exact = metric_table(spark, sf_dir).select(*keys, "active_vehicles")
    rough = metric_table(spark, sf_dir, exact=False).select(*keys, F.col("active_vehicles").alias("estimate"))
    close = F.abs(F.col("estimate") - F.col("active_vehicles")) <= F.greatest(F.lit(1.0), 0.15 * F.col("active_vehicles"))
    return exact.join(rough, keys).select(*keys, "active_vehicles", close.alias("within_bound"))


def q_ingest_publish(spark, sf_dir):
    """Envelopes written to the file form of the bus, keyed, and read back."""
    path = shared_path(spark, "published", unique=True)
    ingest.write_envelopes_files(ingest.envelope(raw_messages(spark, sf_dir)), path)
    env = F.from_json(F.col("value"), ENVELOPE_CHECK_SCHEMA)
    vp = env.getField("payload").getField("VP")
    return finalize(spark.read.parquet(path).select(
        env.getField("mqtt_topic").alias("mqtt_topic"), "key", vp.getField("veh").alias("vehicle_id"),
        env.getField("received_at").alias("received_at")))


def q_export_csv(spark, sf_dir):
    """The metric table exported as CSV with a header and read back with its schema."""
    path = shared_path(spark, "export", unique=True)
    m = metric_table(spark, sf_dir)
    K.write_csv(m, path)
    return finalize(spark.read.option("header", "true").schema(m.schema).csv(path))


def q_display_summary(spark, sf_dir):
    return Q.display_summary(finalize(Q.summary_stats(stored_metrics(spark, sf_dir))))


def q_speed_percentiles(spark, sf_dir):
    return finalize(X.speed_percentiles(positions(spark, sf_dir)))


def q_sketch_percentiles(spark, sf_dir):
    """Daily percentiles merged from 10 s panes, and whether each one's rank among all messages is within 3% of its target."""
    pos, values, probs = positions(spark, sf_dir), ("speed", "delay"), (0.5, 0.95)
    found = X.merged_percentiles(X.pane_sketches(pos), "1 day")
    day = F.window("event_time", "1 day").getField("start").alias("window_start")
    keys = ["window_start", "route", "direction"]
    joined = pos.select(day, "route", "direction", *values).join(found, keys)
    checks = []
    for p in probs:
        for c in values:
            name, n = f"{c}_p{int(round(p * 100))}", F.count(c)
            v, q = F.col(c).cast("double"), F.col(name)
            below, upto = F.count_if(v < q) / n, F.count_if(v <= q) / n
            checks.append(((below <= p + 0.03) & (upto >= p - 0.03)).alias(f"{name}_close"))
    return finalize(joined.groupBy(*keys, "window_end", "speed_n", "delay_n").agg(*checks))


def q_network_levels(spark, sf_dir):
    return finalize(X.metrics_by_level(positions(spark, sf_dir), "1 hour"))


def q_network_metrics(spark, sf_dir):
    return finalize(X.network_metrics(positions(spark, sf_dir), "1 hour"))


def q_downsample(spark, sf_dir):
    """Hourly rows from the 10 s rows, where every seventh message has no speed."""
    pos = positions(spark, sf_dir).withColumn("speed", F.when(F.col("event_id") % 7 != 0, F.col("speed")))
    return finalize(X.downsample(W.window_metrics(pos, "10 seconds", counts=True), "1 hour"))


def q_rollup(spark, sf_dir):
    """Hourly rows refreshed after a first commit that lacks every fiftieth event, and after its corrections."""
    pos = positions(spark, sf_dir).withColumn("speed", F.when(F.col("event_id") % 7 != 0, F.col("speed")))
    late = F.col("event_id") % 50 == 0
    rows = lambda feed: W.window_metrics(feed, "10 seconds", counts=True)
    keys = ["window_start", "window_end", *SERIES_KEYS]
    root = shared_path(spark, "rollup", unique=True)
    source, target = MetricStore(spark, f"{root}/fine"), MetricStore(spark, f"{root}/hourly")
    source.commit(rows(pos.filter(~late)), 0)
    refresh(source, target)
    source.commit(rows(pos).join(rows(pos.filter(late)).select(*keys), keys, "left_semi"), 1)
    refresh(source, target)
    return finalize(target.read().drop("window_date", "window_type"))


def q_retention(spark, sf_dir):
    """Dates before the last seven days are taken out of a store and their files deleted; what is left, from that time on."""
    keep_from = as_of(spark, sf_dir) - F.expr("INTERVAL 7 DAYS")
    store = MetricStore(spark, shared_path(spark, "expiring", unique=True))
    store.load(stored_metrics(spark, sf_dir))
    store.expire(spark.range(1).select(F.to_date(keep_from)).first()[0])
    store.vacuum(keep=1)
    return finalize(X.retention(store.read(), keep_from).drop("window_date"))


def q_range_validation(spark, sf_dir):
    return X.range_validation(positions(spark, sf_dir))


def q_acceleration(spark, sf_dir):
    return finalize(X.acceleration(positions(spark, sf_dir)))


def q_punctuality(spark, sf_dir):
    return finalize(X.punctuality(positions(spark, sf_dir), 20))


def q_route_comparison(spark, sf_dir):
    return finalize(X.route_comparison(positions(spark, sf_dir), COMPARED_ROUTES))


def q_delay_alerts(spark, sf_dir):
    return finalize(X.delay_alerts(positions(spark, sf_dir), 2.0, "1 day"))


def _utc(query: Query) -> Query:
    """Run a registered query under a UTC session time zone.

    Window bounds, the timestamp_ntz ↔ timestamp casts around watermarks and
    parsing of "...Z" times all assume the engine's UTC session setting; the
    caller's session may have another default.
    """
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)
    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


QUERIES: dict[str, Query] = {
    "tumbling_metrics": q_tumbling_metrics,
    "sliding_metrics": q_sliding_metrics,
    "windowed_metrics": q_windowed_metrics,
    "windowed_metrics_1h": q_windowed_metrics_1h,
    "tumbling_nonnull": q_tumbling_nonnull,
    "sliding_from_panes": q_sliding_from_panes,
    "decode_positions": q_decode_positions,
    "ingest_envelope": q_ingest_envelope,
    "vehicle_key": q_vehicle_key,
    "ingest_rejects": q_ingest_rejects,
    "ingest_stats": q_ingest_stats,
    "ingest_stats_60s": q_ingest_stats_60s,
    "topic_filter": q_topic_filter,
    "metrics_query": q_metrics_query,
    "metrics_latest_n": q_metrics_latest_n,
    "metrics_latest_global": q_metrics_latest_global,
    "routes_list": q_routes_list,
    "series_means": q_series_means,
    "route_stats": q_route_stats,
    "summary_stats": q_summary_stats,
    "chart_series": q_chart_series,
    "historical_view": q_historical_view,
    "raw_table": q_raw_table,
    "live_view": q_live_view,
    "live_view_bus": q_live_view_bus,
    "live_view_counts": q_live_view_counts,
    "latest_known": q_latest_known,
    "audit_rollup": q_audit_rollup,
    "metrics_long": q_metrics_long,
    "metrics_pivot": q_metrics_pivot,
    "metrics_upsert": q_metrics_upsert,
    "metrics_store": q_metrics_store,
    "metrics_json": q_metrics_json,
    "line_protocol": q_line_protocol,
    "ingest_publish": q_ingest_publish,
    "export_csv": q_export_csv,
    "display_summary": q_display_summary,
    "stream_metrics_update": q_stream_metrics_update,
    "stream_metrics_append": q_stream_metrics_append,
    "stream_multi_sink": q_stream_multi_sink,
    "stream_store": q_stream_store,
    "stream_bus": q_stream_bus,
    "stream_counters": q_stream_counters,
    "late_data": q_late_data,
    "stream_acceleration": q_stream_acceleration,
    "stream_restart": q_stream_restart,
    "active_vehicles_approx": q_active_vehicles_approx,
    "speed_percentiles": q_speed_percentiles,
    "sketch_percentiles": q_sketch_percentiles,
    "network_metrics": q_network_metrics,
    "network_levels": q_network_levels,
    "downsample": q_downsample,
    "rollup": q_rollup,
    "retention": q_retention,
    "range_validation": q_range_validation,
    "acceleration": q_acceleration,
    "punctuality": q_punctuality,
    "route_comparison": q_route_comparison,
    "delay_alerts": q_delay_alerts,
}

QUERIES = {key: _utc(fn) for key, fn in QUERIES.items()}
