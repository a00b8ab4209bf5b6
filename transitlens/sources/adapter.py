"""Adapter from the driver's ``events`` table to vehicle-position data.

There is no live feed in the test environment, so the ``events`` table stands
in for it. Column mapping (kept identical in every oracle):

* event_time = ts
* route      = event_type
* direction  = user_id % 2 + 1, as text
* vehicle_id = user_id
* speed      = value
* delay      = props.k - 50

From the same rows we can also rebuild the raw messages the ingest side would
see (topic + JSON payload bytes) and the bus envelope the decoder reads, so
ingest and decode run over data whose size grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ISO-8601 with microseconds and a literal Z: to_json's default timestamp
# pattern keeps only milliseconds, which would change event times.
TST_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# Fixed topic layout of the generated feed (levels separated by "/"):
# "", hfp, v2, journey, <temporal>, vp, <mode>, veh, <vehicle>, <route>, <direction>
TEMPORAL_LEVELS = ["ongoing", "upcoming"]
TRANSPORT_MODES = ["bus", "tram"]


def delay_from_props(props: Column) -> Column:
    return F.from_json(props, "k INT").getField("k") - F.lit(50)


def positions_from_events(events: DataFrame) -> DataFrame:
    """Flat position rows (event_time, route, direction, vehicle_id, speed, delay).

    ``event_time`` keeps the table's ``timestamp_ntz`` type; streaming code
    converts it to ``timestamp`` where a watermark needs it.
    """
    return events.select(
        F.col("event_id"),
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("route"),
        (F.col("user_id") % 2 + 1).cast("string").alias("direction"),
        F.col("user_id").alias("vehicle_id"),
        F.col("value").alias("speed"),
        delay_from_props(F.col("props")).alias("delay"),
    )


def topic_for(event_id: Column, vehicle: Column, route: Column, direction: Column,
              with_marker: Column | None = None, empty_vehicle: Column | None = None) -> Column:
    """Topic text for one position message.

    Temporal level cycles over ongoing / upcoming / (level missing) by
    ``event_id % 3``; mode is bus or tram by ``event_id % 2``.
    """
    temporal = (F.when(event_id % 3 == 0, F.lit("/" + TEMPORAL_LEVELS[0]))
                .when(event_id % 3 == 1, F.lit("/" + TEMPORAL_LEVELS[1]))
                .otherwise(F.lit("")))
    mode = F.when(event_id % 2 == 0, F.lit(TRANSPORT_MODES[0])) \
        .otherwise(F.lit(TRANSPORT_MODES[1]))
    veh_text = vehicle.cast("string")
    if empty_vehicle is not None:
        veh_text = F.when(empty_vehicle, F.lit("")).otherwise(veh_text)
    marker = F.lit("/veh/")
    if with_marker is not None:
        marker = F.when(with_marker, F.lit("/veh/")).otherwise(F.lit("/car/"))
    return F.concat(F.lit("/hfp/v2/journey"), temporal, F.lit("/vp/"), mode, marker,
                    veh_text, F.lit("/"), route, F.lit("/"), direction)


def vp_struct(drop_dir: Column | None = None, bad_tst: Column | None = None) -> Column:
    """The VP record built from position columns (names as in the feed)."""
    tst = F.date_format(F.col("event_time"), TST_PATTERN)
    if bad_tst is not None:
        tst = F.when(bad_tst, F.lit("nope")).otherwise(tst)
    direction = F.col("direction")
    if drop_dir is not None:
        direction = F.when(~drop_dir, direction)
    return F.struct(
        F.col("route").alias("desi"),
        direction.alias("dir"),
        (F.col("vehicle_id") % 100).cast("int").alias("oper"),
        F.col("vehicle_id").cast("int").alias("veh"),
        tst.alias("tst"),
        (F.lit(60.0) + (F.col("vehicle_id") % 100) * F.lit(0.001)).alias("lat"),
        (F.lit(24.0) + (F.col("event_id") % 100) * F.lit(0.001)).alias("long"),
        F.col("speed").alias("spd"),
        F.col("delay").alias("dl"),
    )


def received_at(event_time: Column) -> Column:
    """Epoch seconds (double) of the receive time; here equal to the event time."""
    return F.unix_micros(event_time.cast("timestamp")) / F.lit(1_000_000.0)


def raw_messages_from_events(events: DataFrame, utf8_every: int = 101,
                             json_every: int = 97) -> DataFrame:
    """Raw (topic, payload bytes, received_at) messages with deterministic faults.

    ``event_id % json_every == 0`` gets a cut-off JSON text; ``event_id %
    utf8_every == 0`` gets a byte sequence that is not UTF-8. Every row of the
    table is turned into a message.
    """
    pos = positions_from_events(events)
    payload = F.to_json(F.struct(vp_struct().alias("VP")))
    text_bytes = F.encode(payload, "UTF-8")
    broken_json = F.encode(F.substring(payload, 1, 20), "UTF-8")
    bad_utf8 = F.concat(F.unhex(F.lit("FF")), text_bytes)
    body = (F.when(F.col("event_id") % utf8_every == 0, bad_utf8)
            .when(F.col("event_id") % json_every == 0, broken_json)
            .otherwise(text_bytes))
    return pos.select(
        F.col("event_id"),
        topic_for(F.col("event_id"), F.col("vehicle_id"), F.col("route"), F.col("direction"))
        .alias("topic"),
        body.alias("payload"),
        received_at(F.col("event_time")).alias("received_at"),
    )


def envelope_messages_from_events(events: DataFrame, truncate_every: int = 97,
                                  drop_dir_every: int = 89, bad_tst_every: int = 83) -> DataFrame:
    """Bus records (key, value JSON text) as the decoder receives them.

    Deterministic faults: a cut-off JSON text, a missing ``dir`` field, and an
    unparseable ``tst``; these rows must be dropped by the decoder.
    """
    pos = positions_from_events(events)
    eid = F.col("event_id")
    envelope = F.to_json(F.struct(
        topic_for(eid, F.col("vehicle_id"), F.col("route"), F.col("direction"))
        .alias("mqtt_topic"),
        F.struct(vp_struct(drop_dir=(eid % drop_dir_every == 0),
                           bad_tst=(eid % bad_tst_every == 0)).alias("VP")).alias("payload"),
        received_at(F.col("event_time")).alias("received_at"),
    ))
    value = F.when(eid % truncate_every == 0,
                   F.substring(envelope, 1, 40)).otherwise(envelope)
    return pos.select(
        eid,
        F.col("vehicle_id").cast("string").alias("key"),
        value.alias("value"),
    )
