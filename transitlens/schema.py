"""Schemas and fixed names shared by every operator.

Fixed values (must stay equal to the reference's message and metric formats):

* envelope fields: mqtt_topic, payload, received_at
* position event type: VP, with fields desi, dir, oper, veh, tst, lat, long,
  spd, hdg, dl, odo, drst, oday, jrn, line, start
* window type labels: tumbling_10s, sliding_60s
* metric fields: vehicle_count, active_vehicles, avg_speed, avg_delay,
  min_delay, max_delay
* time-series measurement name: vehicle_metrics
* series tags: route, direction, window_type
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

TUMBLING_LABEL = "tumbling_10s"
SLIDING_LABEL = "sliding_60s"
MEASUREMENT = "vehicle_metrics"

METRIC_FIELDS = [
    "vehicle_count",
    "active_vehicles",
    "avg_speed",
    "avg_delay",
    "min_delay",
    "max_delay",
]
SERIES_KEYS = ["route", "direction", "window_type"]
METRIC_COLUMNS = ["window_start", "window_end", *SERIES_KEYS, *METRIC_FIELDS]

# Fields summarised by the route statistics call and the dashboard.
SUMMARY_FIELDS = ["vehicle_count", "avg_speed", "avg_delay"]

# Only the fields that are read: Spark keeps the whole struct when several fields
# of one from_json are selected, so a narrow declaration is the pruning that matters.
VP_USED = StructType([
    StructField("desi", StringType()),
    StructField("dir", StringType()),
    StructField("oper", IntegerType()),
    StructField("veh", IntegerType()),
    StructField("tst", StringType()),
    StructField("lat", DoubleType()),
    StructField("long", DoubleType()),
    StructField("spd", DoubleType()),
    StructField("dl", IntegerType()),
])


def envelope_schema(vp: StructType = VP_USED) -> StructType:
    return StructType([
        StructField("mqtt_topic", StringType(), nullable=False),
        StructField("payload", StructType([StructField("VP", vp)])),
        StructField("received_at", DoubleType(), nullable=False),
    ])


DECODE_SCHEMA = envelope_schema(VP_USED)
