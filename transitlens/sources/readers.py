"""Table, file and bus readers.

Batch reads go through Parquet so Catalyst can prune columns and push
predicates into the scan. Bus (Kafka) readers are thin option sets: the
connector package must be on the cluster's class path; nothing here depends
on it at import time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a lazily scanned Parquet relation.

    Split size comes from ``spark.sql.files.maxPartitionBytes`` alone, for
    every input alike.
    """
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def event_schema(spark: SparkSession, sf_dir: str) -> StructType:
    return read_events(spark, sf_dir).schema


def stream_events(spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """The events table as a file stream (same rows, incremental offsets).

    A file source over the table's folder, restricted to its file by name, so
    a streaming query can be checked against the batch one on equal input.
    """
    reader = (spark.readStream.schema(event_schema(spark, sf_dir))
              .option("pathGlobFilter", "events.parquet"))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(sf_dir)


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Subscribe to a bus topic as a stream of (key, value, ...) records."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def kafka_batch(spark: SparkSession, bootstrap_servers: str, topic: str,
                starting_offsets: str = "earliest", ending_offsets: str = "latest") -> DataFrame:
    """Bounded read of a bus topic between two offset specs."""
    return (spark.read.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("endingOffsets", ending_offsets)
            .load())
