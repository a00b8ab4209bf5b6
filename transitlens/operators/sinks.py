"""Output forms of the metric rows: JSON messages, line-protocol points and a
partitioned Parquet store. All text is built with column expressions and
written by the executors; nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlens.schema import MEASUREMENT, METRIC_COLUMNS, METRIC_FIELDS, SERIES_KEYS

# Fixed JSON field order of a published metric message.
JSON_FIELDS = [*METRIC_COLUMNS, "processed_at"]
STORE_PARTITIONS = ["window_date", "window_type"]

# Field kinds in a stored point: integer counts, float averages and
# delay bounds (delays are written as floats in the reference's store).
INT_FIELDS = ["vehicle_count", "active_vehicles"]
FLOAT_FIELDS = ["avg_speed", "avg_delay", "min_delay", "max_delay"]


def with_processed_at(df: DataFrame) -> DataFrame:
    """Processing-time stamp (one value per query / micro-batch)."""
    return df.withColumn("processed_at", F.current_timestamp())


def metrics_json(df: DataFrame, key_col: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """Bus messages: ``value`` = JSON object of the row (null fields omitted).

    ``key_col`` (e.g. route) keys the message so one series stays in one bus
    partition; the reference publishes without a key. ``carry`` names columns
    to keep beside the message.
    """
    cols = [c for c in JSON_FIELDS if c in df.columns]
    value = F.to_json(F.struct(*[F.col(c) for c in cols]),
                      {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                       "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return df.select(key.alias("key"), value.alias("value"), *(carry or []))


def _escape_tag(c: Column) -> Column:
    # A backslash, comma, equals sign or space in a tag value is escaped; a line break, which
    # would end the point, is written as a backslash and a letter.
    text = F.regexp_replace(c.cast("string"), r"([\\,= ])", r"\\$1")
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def line_protocol(df: DataFrame, time_col: str = "window_end",
                  measurement: str = MEASUREMENT) -> DataFrame:
    """One point per row: ``measurement,tags fields time_ns``.

    Null and non-finite fields are left out (the row is kept), as are null
    and empty tags; a row without any field is dropped, as a point needs at
    least one.
    """
    tags = F.concat_ws(",", F.lit(measurement),
                       *[F.when(F.col(t) != "", F.concat(F.lit(f"{t}="), _escape_tag(F.col(t))))
                         for t in SERIES_KEYS])
    parts = []
    for f in INT_FIELDS:
        v = F.col(f)
        parts.append(F.when(v.isNotNull(), F.concat(F.lit(f"{f}="), v.cast("bigint").cast("string"),
                                                     F.lit("i"))))
    for f in FLOAT_FIELDS:
        v = F.col(f).cast("double")
        parts.append(F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")),
                            F.concat(F.lit(f"{f}="), v.cast("string"))))
    fields = F.concat_ws(",", *parts)
    nanos = F.unix_micros(F.col(time_col).cast("timestamp")) * F.lit(1000)
    line = F.concat_ws(" ", tags, fields, nanos.cast("string"))
    return df.select(line.alias("value"), (fields != "").alias("_has_fields")) \
        .filter("_has_fields").select("value")


def parse_points(lines: DataFrame, *carry: str) -> DataFrame:
    """Points read back: measurement, the tags, the fields as doubles, ``time_ns`` and the ``carry`` columns."""
    # A blank that is not escaped ends the tags and the fields.
    parts = F.split(F.regexp_replace(F.replace(F.col("value"), F.lit("\\\\"), F.lit("\u0001")), r"(?<!\\) ", "\n"), "\n")
    tags, fields = F.element_at(parts, 1), F.element_at(parts, 2)

    def tag(name: str) -> Column:
        text = F.nullif(F.regexp_extract(tags, f",{name}=((?:\\\\.|[^,])*)", 1), F.lit(""))
        return F.replace(F.regexp_replace(text, r"\\(.)", "$1"), F.lit("\u0001"), F.lit("\\")).alias(name)

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract(fields, f"(?:^|,){name}=([^,i]*)", 1), F.lit("")).cast("double").alias(name)

    return lines.select(F.regexp_extract(tags, "^[^,]*", 0).alias("measurement"), *[tag(t) for t in SERIES_KEYS],
                        *[field(f) for f in METRIC_FIELDS], F.element_at(parts, 3).cast("bigint").alias("time_ns"), *carry)


def with_store_partitions(df: DataFrame) -> DataFrame:
    return df.withColumn("window_date", F.to_date(F.col("window_end")))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export with a header (dashboard download)."""
    df.write.mode(mode).option("header", "true").csv(path)
