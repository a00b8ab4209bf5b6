"""Decode bus envelopes into the flat vehicle-position table.

Permissive JSON decoding against the declared (narrow) schema: text that is
not JSON, or has the wrong shape, becomes nulls; a field of the wrong type is
null on its own. Rows without route, direction or a parseable event time are
dropped. Narrow projection + filter: no shuffle, one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from transitlens.functions.columns import parse_time
from transitlens.schema import DECODE_SCHEMA


def decode_positions(messages: DataFrame, value_col: str = "value",
                     schema: StructType = DECODE_SCHEMA, keep: list[str] | None = None,
                     nan_speed_to_null: bool = True) -> DataFrame:
    data = F.from_json(F.col(value_col).cast("string"), schema)
    vp = data.getField("payload").getField("VP")
    speed = vp.getField("spd")
    if nan_speed_to_null:
        speed = F.when(~F.isnan(speed), speed)
    flat = messages.select(
        *(keep or []),
        data.getField("mqtt_topic").alias("mqtt_topic"),
        parse_time(vp.getField("tst")).alias("event_time"),
        vp.getField("desi").alias("route"),
        vp.getField("dir").alias("direction"),
        vp.getField("veh").alias("vehicle_id"),
        speed.alias("speed"),
        vp.getField("dl").alias("delay"),
        vp.getField("lat").alias("latitude"),
        vp.getField("long").alias("longitude"),
        vp.getField("oper").alias("operator"),
    )
    return flat.filter(F.col("route").isNotNull() & F.col("direction").isNotNull()
                       & F.col("event_time").isNotNull())


METRIC_MESSAGE_SCHEMA = (
    "window_start timestamp_ntz, window_end timestamp_ntz, route string, direction string, "
    "window_type string, vehicle_count bigint, active_vehicles bigint, avg_speed double, "
    "avg_delay double, min_delay int, max_delay int, processed_at timestamp")


def metrics_from_messages(messages: DataFrame, *carry: str, value_col: str = "value") -> DataFrame:
    """Metric messages read back from the bus (live consumer side).

    Null, non-JSON or incomplete messages (no series tags or window end) are
    skipped; missing tags become "" as in the dashboard. ``carry`` names
    columns of the messages to keep.
    """
    # Streams publish instants, with a Z; the table's wall clock is UTC.
    text = F.regexp_replace(F.col(value_col).cast("string"), r'("window_(?:start|end)":"[^"]*)Z"', '$1"')
    rec = F.from_json(text, METRIC_MESSAGE_SCHEMA,
                      {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"})
    rows = messages.select(rec.alias("m"), *carry).select("m.*", *carry)
    return (rows.filter(F.col("window_end").isNotNull()
                        & (F.col("route").isNotNull() | F.col("direction").isNotNull()))
            .withColumn("route", F.coalesce("route", F.lit("")))
            .withColumn("direction", F.coalesce("direction", F.lit("")))
            .withColumn("window_type", F.coalesce("window_type", F.lit(""))))
