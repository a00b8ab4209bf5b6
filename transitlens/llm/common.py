"""Helpers shared by the training-data operators.

Text columns may be null (read as the empty text unless a docstring says
otherwise); every operator reads only the columns it is told to read, so extra
columns and clashing names in its input do no harm.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.session import shared_path
from transitlens.sources.files import delete

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: A word is a maximal run of characters other than space and \t..\r.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from the driver's folder.

    On a cluster the package is installed or sent with ``--py-files``; the
    entry only helps where workers see the same path.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


#: Whether a finished execution's shuffle files go at once; else they stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: The folders that ``stored`` has written since each open ``temporary`` block began, innermost last.
_WRITTEN: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that ``stored`` writes inside the block go at its end, apart from those that a frame given to ``keep`` reads.

    Yields ``keep``, which returns the frame. What still reads other tables of
    the block has to be worked off, that is stored or collected, inside it.
    """
    written: list[str] = []
    kept: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        files = df.inputFiles()
        kept.extend(path for path in written if any(os.path.basename(path) in file for file in files))
        return df

    _WRITTEN.append(written)
    try:
        yield keep
    finally:
        _WRITTEN.pop()
        for path in written:
            if path not in kept:
                delete(spark, path)
        if _WRITTEN:
            _WRITTEN[-1].extend(path for path in written if path in kept)


def stored(df: DataFrame, name: str, compression: str | None = None, **options: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again.

    Cuts lineage with a table every executor can read, so a lost executor
    costs a read and not a recomputation. The write's shuffle files go when it
    is done: the table stands for them.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", name, unique=True)
    if _WRITTEN:
        _WRITTEN[-1].append(path)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path, compression=compression)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches in slices, so that what a task makes of one at a time stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: What empties the tables that a Python worker keeps from task to task, by operator.
_KEPT: dict[str, Callable[[], None]] = {}


def kept_by(operator: str, empty: Callable[[], None]) -> None:
    _KEPT[operator] = empty


def keep_only(operator: str | None = None) -> None:
    """A worker that goes on with another operator lets go of what the ones before have kept."""
    for other, empty in _KEPT.items():
        if other != operator:
            empty()


def id_crc(doc_id: str = "doc_id"):
    """crc32 of an id written as text (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def python_id_crc(doc_id) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def connected_components(edges: DataFrame, name: str = "components", left: str = "a",
                         right: str = "b") -> DataFrame:
    """(id, component) for every node of ``edges``; component is the least id.

    Label propagation with pointer jumping on DataFrames only. A round takes
    the least label among a node and its neighbours (``min`` pre-aggregates on
    the map side, so a hub with many links is no hot task) and then follows
    the label's own label, which halves the distance to the root. Each round's
    labels are one table in the shared folder. The loop ends when a round
    changes nothing; it has no cap.
    """
    links = stored(edges.select(F.col(left).alias("a"), F.col(right).alias("b"))
                   .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
                   .select(F.inline(F.array(F.struct(F.col("a"), F.col("b")),
                                            F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))), f"{name}-links")
    labels = stored(links.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), f"{name}-labels")
    while True:
        near = (links.join(labels, links.b == labels.id).groupBy(F.col("a").alias("_a"))
                .agg(F.min("component").alias("other")))
        root = labels.select(F.col("id").alias("_r"), F.col("component").alias("root"))
        lower = labels.join(near, labels.id == F.col("_a")).select(
            "id", F.col("component").alias("was"), F.least("component", "other").alias("low"))
        after = stored(lower.join(root, F.col("low") == F.col("_r"), "left").select(
            "id", "was", F.least(F.coalesce("root", "low"), F.col("low")).alias("component")), f"{name}-labels")
        labels = after.select("id", "component")
        if after.filter("component <> was").isEmpty():
            return labels


def merged_components(components: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """(id, component) once more links (a, b) are known; only the classes that they join are labelled anew."""
    ends = edges.select(F.col("a").alias("id"), F.col("b").alias("_b"))
    one = labelled(ends, components).select(F.col("component").alias("a"), F.col("_b").alias("id"))
    both = stored(labelled(one, components).select("a", F.col("component").alias("b")).filter("a <> b"), f"{name}-joined")
    if both.isEmpty():
        return components
    joined = connected_components(both, name).select(F.col("id").alias("_id"), F.col("component").alias("_to"))
    known = components.unionByName(joined.select(F.col("_id").alias("id"), F.col("_id").alias("component"))).groupBy("id").agg(
        F.min("component").alias("component"))
    return stored(known.join(joined, F.col("component") == F.col("_id"), "left").select(
        "id", F.coalesce("_to", "component").alias("component")), f"{name}-merged")


def labelled(members: DataFrame, components: DataFrame) -> DataFrame:
    """``members`` with ``component``: that of the id, or the id itself."""
    known = components.withColumnRenamed("id", "_id")
    return members.join(known, members.id == known["_id"], "left").drop("_id").withColumn(
        "component", F.coalesce("component", "id"))


def open_members(members: DataFrame, components: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with ``component``."""
    rows = labelled(members, components)
    mixed = rows.groupBy("bucket").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    return rows.join(mixed.filter("_low <> _high").select("bucket"), "bucket")
