"""Ingest: wrap raw topic messages into bus envelopes.

Input: ``DataFrame[topic string, payload binary, received_at double]`` (a
batch table or a stream). Each message is classified once: bytes that are
not UTF-8 → ``utf8``; text that is not JSON → ``json_decode``; otherwise it
is good and becomes an envelope ``{mqtt_topic, payload, received_at}`` keyed
by the vehicle taken from the topic, so one vehicle's messages stay in one
bus partition.

JSON is taken strictly: text with a repeated key in one object, with a bare
NaN or Infinity or with more after its value counts as ``json_decode``, since readers of the bus would not
agree on it. The payload is written anew, so key order and white space of the
original text are not kept; its values are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.functions.columns import matches_topic, vehicle_key

REASON_UTF8 = "utf8"
REASON_JSON = "json_decode"
SCHEMA_VERSION = 1


def classify(raw: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Adds ``payload_text``, ``payload_json`` (VARIANT) and ``reject_reason``."""
    text = F.col(payload_col).cast("string")
    valid = F.try_validate_utf8(text)
    # The parser stops after the first value; inside brackets a second one shows.
    whole = F.try_parse_json(F.concat(F.lit("["), valid, F.lit("]")))
    single = whole.isNotNull() & F.try_variant_get(whole, "$[1]", "variant").isNull()
    parsed = F.when(single, F.try_parse_json(valid))
    reason = (F.when(~F.is_valid_utf8(text), F.lit(REASON_UTF8))
              .when(F.col("payload_json").isNull(), F.lit(REASON_JSON)))
    return (raw.withColumn("payload_text", text)
            .withColumn("payload_json", parsed)
            .withColumn("reject_reason", reason))


def good_messages(raw: DataFrame) -> DataFrame:
    return classify(raw).filter(F.col("reject_reason").isNull())


def rejects(raw: DataFrame) -> DataFrame:
    """Rejected messages with their reason (the stream continues without them)."""
    return (classify(raw).filter(F.col("reject_reason").isNotNull())
            .drop("payload_json", "payload_text"))


def envelope(raw: DataFrame, marker: str = "veh", schema_version: int | None = SCHEMA_VERSION,
             keep: list[str] | None = None) -> DataFrame:
    """Good messages as bus records: ``key`` (vehicle id or null) and ``value`` JSON.

    The payload is nested as JSON (not as an escaped string) and non-ASCII
    text is written as is.
    """
    fields = [F.col("topic").alias("mqtt_topic"), F.col("payload_json").alias("payload"),
              F.col("received_at")]
    if schema_version is not None:
        fields.append(F.lit(schema_version).alias("schema_version"))
    return good_messages(raw).select(
        *(keep or []),
        vehicle_key(F.col("topic"), marker).alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
    )


def ingest_stats(raw: DataFrame, *group_cols) -> DataFrame:
    """messages_processed, errors, success_rate (100.0 when nothing arrived).

    Optional ``group_cols`` (e.g. a 60-second ``window(received_at)``) give one
    row per reporting interval instead of one for the whole input.
    """
    c = classify(raw)
    ok = F.count_if(F.col("reject_reason").isNull())
    err = F.count_if(F.col("reject_reason").isNotNull())
    agg = (c.groupBy(*group_cols) if group_cols else c.groupBy()).agg(
        ok.alias("messages_processed"), err.alias("errors"))
    total = F.col("messages_processed") + F.col("errors")
    rate = F.when(total == 0, F.lit(100.0)).otherwise(
        F.round(F.col("messages_processed") / total * 100.0, 2))
    return agg.withColumn("success_rate", rate)


def filter_topics(raw: DataFrame, topic_filter: str, topic_col: str = "topic") -> DataFrame:
    """Keep messages whose topic matches an MQTT-style subscription filter."""
    return raw.filter(matches_topic(F.col(topic_col), topic_filter))


def write_envelopes_kafka(records: DataFrame, bootstrap_servers: str, topic: str):
    """Publish keyed envelopes on the bus (batch); keyed so a vehicle keeps its partition."""
    return (records.select("key", "value").write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("topic", topic)
            .option("kafka.acks", "all")
            .option("kafka.retries", "3")
            .option("kafka.max.in.flight.requests.per.connection", "1")
            .save())


def write_envelopes_files(records: DataFrame, path: str):
    """File stand-in for the bus: records clustered by vehicle key.

    ``REBALANCE`` by key keeps a vehicle's records together, while AQE
    splits a vehicle sending a large share of all messages over several
    tasks instead of one.
    """
    out = records.select("key", "value").hint("rebalance", "key")
    return out.write.mode("overwrite").parquet(path)
