"""A record log with topics, partitions and offsets, kept as files.

Stands for the bus where no broker is: producers append segments, consumers
read between offsets, from positions that they store. Below ``root/topic``:

* ``segments/segment=<n>/partition=<p>/`` Parquet rows of (offset, key, value);
* ``log/<n>.json`` the offsets of segment n, [first, end) for each partition,
  written last, so that a segment is there as a whole or not at all;
* ``positions/<group>/<n>.json`` a consumer group's positions.

Records of one key are in one partition, in order. Offsets are given out
without gathering a partition in one task: every task of a segment numbers its
own records, and a window over the tasks' counts says where it starts.

``RecordLog`` reads and writes with Spark. ``RecordLogSource`` is the streaming
source: offsets in the checkpoint are these offsets, and tasks read their range
of a partition's segments with pyarrow, on any file system that it knows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from transitlens.sources import files

RECORD_SCHEMA = "partition int, offset long, key string, value string"
Position = dict[int, int]


def _segment(n: int) -> str:
    return f"segment={n:012d}"


class RecordLog:
    """One topic."""

    def __init__(self, spark: SparkSession, root: str, topic: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/{topic}"

    def _segments(self) -> list[tuple[int, dict]]:
        names = [n for n in files.names(self.spark, f"{self.path}/log") if n[0].isdigit()]
        return [(int(n.removesuffix(".json")), json.loads(files.read_text(self.spark, f"{self.path}/log/{n}"))) for n in names]

    def ends(self) -> Position:
        """The next offset of each partition."""
        segments = self._segments()
        return {int(p): end for p, (_, end) in segments[-1][1].items()} if segments else {}

    def begins(self) -> Position:
        segments = self._segments()
        return {int(p): first for p, (first, _) in segments[0][1].items()} if segments else {}

    def publish(self, records: DataFrame, partitions: int = 3, order: list[str] | None = None) -> Position:
        """Append (key, value) records as one segment; returns the new ends.

        ``order`` names columns whose order the offsets follow; without it they
        follow the order in which the tasks read.
        """
        segments = self._segments()
        n, ends = (segments[-1][0] + 1 if segments else 0), self.ends()
        if ends and len(ends) != partitions:
            raise ValueError(f"the topic has {len(ends)} partitions")
        partition = F.pmod(F.xxhash64(F.coalesce(F.col("key").cast("string"), F.col("value").cast("string"))), F.lit(partitions)).cast("int")
        rows = records.repartitionByRange(*order).sortWithinPartitions(*order) if order else records
        staging = f"{self.path}/staging/{n:012d}"
        (rows.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), partition.alias("partition"),
                     F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("place"))
         .write.mode("overwrite").parquet(staging))
        staged = self.spark.read.schema("key string, value string, partition int, task int, place long").parquet(staging)
        tasks = staged.groupBy("partition", "task").agg(F.count("*").alias("n"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy("partition").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        first = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in (ends or {0: 0}).items() for x in pair]), F.col("partition")), F.lit(0))
        bases = tasks.select("partition", "task", (before + first).alias("base"))
        mine = F.row_number().over(Window.partitionBy("partition", "task").orderBy("place")) - 1
        placed = staged.withColumn("mine", mine).join(bases, ["partition", "task"]).select(
            "partition", (F.col("base") + F.col("mine")).cast("long").alias("offset"), "key", "value")
        target = f"{self.path}/segments/{_segment(n)}"
        placed.hint("rebalance", "partition").sortWithinPartitions("partition", "offset").write.mode("overwrite").partitionBy("partition").parquet(target)
        counts = {r["partition"]: r["n"] for r in tasks.groupBy("partition").agg(F.sum("n").alias("n")).collect()}
        spans = {p: (ends.get(p, 0), ends.get(p, 0) + counts.get(p, 0)) for p in range(partitions)}
        files.write_text(self.spark, f"{self.path}/log/{n:012d}.json", json.dumps(spans))
        files.delete(self.spark, staging)
        return {p: end for p, (_, end) in spans.items()}

    def read(self, start: Position | None = None, end: Position | None = None) -> DataFrame:
        """Records from ``start`` (else all) up to ``end`` (else the ends as they are now), not included."""
        segments = self._segments()
        start = {**self.begins(), **(start or {})}
        end = {**self.ends(), **(end or {})}
        paths, ranges = [], []
        for p in end:
            touched = [n for n, spans in segments if spans[str(p)][0] < end[p] and spans[str(p)][1] > start[p]]
            if touched:
                paths += [f"{self.path}/segments/{_segment(n)}/partition={p}" for n in touched]
                ranges.append((F.col("partition") == p) & (F.col("offset") >= start[p]) & (F.col("offset") < end[p]))
        if not paths:
            return self.spark.createDataFrame([], RECORD_SCHEMA)
        wanted = ranges[0]
        for r in ranges[1:]:
            wanted |= r
        rows = (self.spark.read.schema("offset long, key string, value string, segment string, partition int")
                .option("basePath", f"{self.path}/segments").parquet(*paths))
        return rows.filter(wanted).select("partition", "offset", "key", "value")

    def back(self, n: int) -> Position:
        """The position ``n`` records before the end of each partition."""
        begins = self.begins()
        return {p: max(begins[p], end - n) for p, end in self.ends().items()}

    def poll(self, position: Position, most: int) -> tuple[DataFrame, Position]:
        """At most ``most`` records from ``position`` on, dealt evenly over the partitions, and the position after them."""
        ends, begins = self.ends(), self.begins()
        at = {p: max(position.get(p, begins[p]), begins[p]) for p in ends}
        after, left = dict(at), most
        while left and any(after[p] < ends[p] for p in ends):
            waiting = [p for p in sorted(ends) if after[p] < ends[p]]
            share = max(1, left // len(waiting))
            for p in waiting:
                step = min(share, ends[p] - after[p], left)
                after[p], left = after[p] + step, left - step
        return self.read(at, after), after

    # Consumer groups

    def position(self, group: str) -> Position | None:
        names = [n for n in files.names(self.spark, f"{self.path}/positions/{group}") if n[0].isdigit()]
        if not names:
            return None
        return {int(p): o for p, o in json.loads(files.read_text(self.spark, f"{self.path}/positions/{group}/{names[-1]}")).items()}

    def commit(self, group: str, position: Position) -> None:
        folder = f"{self.path}/positions/{group}"
        names = [n for n in files.names(self.spark, folder) if n[0].isdigit()]
        n = int(names[-1].removesuffix(".json")) + 1 if names else 0
        files.write_text(self.spark, f"{folder}/{n:012d}.json", json.dumps(position))
        for old in names[:-1]:
            files.delete(self.spark, f"{folder}/{old}")

    # Retention

    def trim(self, keep: int) -> None:
        """Delete all but the last ``keep`` segments; the begins move."""
        for n, _ in self._segments()[:-keep]:
            files.delete(self.spark, f"{self.path}/log/{n:012d}.json")
            files.delete(self.spark, f"{self.path}/segments/{_segment(n)}")


class Span(InputPartition):
    """Offsets [first, end) of a partition in some segments."""

    def __init__(self, partition: int, first: int, end: int, folders: list[str]):
        self.partition, self.first, self.end, self.folders = partition, first, end, folders


class RecordLogReader(DataSourceStreamReader):
    def __init__(self, path: str, starting: str):
        self.path, self.starting = path, starting

    def _segments(self) -> list[tuple[int, dict]]:
        fs, path = pafs.FileSystem.from_uri(self.path)
        found = fs.get_file_info(pafs.FileSelector(f"{path}/log", allow_not_found=True))
        out = []
        for info in sorted(found, key=lambda i: i.base_name):
            if info.base_name[0].isdigit():
                with fs.open_input_stream(info.path) as f:
                    out.append((int(info.base_name.removesuffix(".json")), json.loads(f.read())))
        return out

    def initialOffset(self) -> dict:
        segments = self._segments()
        if self.starting == "latest":
            return self.latestOffset()
        return {p: span[0] for p, span in segments[0][1].items()} if segments else {}

    def latestOffset(self) -> dict:
        segments = self._segments()
        return {p: span[1] for p, span in segments[-1][1].items()} if segments else {}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        segments, out = self._segments(), []
        for p, last in end.items():
            first = start.get(p, 0)
            known = min((spans[p][0] for _, spans in segments), default=0)
            if first < known and first < last:
                raise ValueError(f"offsets {first} to {known} of partition {p} are gone")
            for n, spans in segments:  # one task for each segment of a partition
                a, b = max(first, spans[p][0]), min(last, spans[p][1])
                if a < b:
                    out.append(Span(int(p), a, b, [f"segments/{_segment(n)}/partition={p}"]))
        return out

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(self.path)
        offset = pc.field("offset")
        for folder in partition.folders:
            rows = ds.dataset(f"{path}/{folder}", filesystem=fs, format="parquet", exclude_invalid_files=False)
            for batch in rows.to_batches(columns=["offset", "key", "value"], filter=(offset >= partition.first) & (offset < partition.end)):
                yield pa.RecordBatch.from_arrays([pa.array([partition.partition] * batch.num_rows, pa.int32()), *batch.columns],
                                                 ["partition", "offset", "key", "value"])

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class RecordLogSource(DataSource):
    """``spark.readStream.format("record_log").option("path", <topic folder>)``; ``startingOffsets`` earliest (default) or latest."""

    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        return RECORD_SCHEMA

    def streamReader(self, schema) -> RecordLogReader:
        return RecordLogReader(self.options["path"], self.options.get("startingOffsets", "earliest"))


def stream_log(spark: SparkSession, root: str, topic: str, starting: str = "earliest") -> DataFrame:
    """A topic as a stream of (partition, offset, key, value)."""
    spark.dataSource.register(RecordLogSource)
    path = f"{root.rstrip('/')}/{topic}"
    return spark.readStream.format("record_log").option("path", path if "://" in path or path.startswith("file:") else f"file://{path}") \
        .option("startingOffsets", starting).load()
