"""Packing of documents into sequences of bounded length.

A document is its ids and an end id. Only longer ones are cut: all pieces but
the first have the full length. Tasks encode the texts and number the pieces of
each length; the number of pieces by length, one row for each possible length,
is all that reaches the driver, which plans for these (``packing_plan``).
Pieces of one length are interchangeable, so that a piece finds its sequence by
its number among those of its length: its number in its task and the sum of
what earlier tasks have, a window over counts. Nothing is gathered by sequence
or by length.

Defined cases: a null or empty text is the end id alone; null and repeated ids
are kept, each row is a document; texts are read whole; an empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.llm.byte_ids import ByteIds
from transitlens.llm.common import ready, stored
from transitlens.llm.packing_plan import plan

#: Characters that a task encodes at once (a longer text goes alone).
CHARACTERS = 4_000_000


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    first, size = 0, 0
    for i, text in enumerate(batch.column(1)):
        size += len(text.as_buffer()) if text.is_valid else 0
        if size > CHARACTERS:
            if i > first:
                yield batch.slice(first, i - first)
            first, size = i, len(text.as_buffer()) if text.is_valid else 0
    yield batch.slice(first)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; the first one may be shorter."""
    head = (length - 1) % capacity + 1
    return [(0, head), *((start, capacity) for start in range(head, length, capacity))]


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids if asked for, and ``part`` and ``number``: the task
    and how many pieces of this length came before in it."""
    ready(docs.sparkSession)
    fields = [T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
              T.StructField("part", T.IntegerType()), T.StructField("number", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seen = ByteIds(path), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for rows in _slices(batch):
                at, out, each = [], [], []
                for i, ids in enumerate(coder.encode(rows.column(1).to_pylist())):
                    ids = np.append(ids, end_id).astype("<u4")
                    for n, (start, length) in enumerate(cut(len(ids), capacity)):
                        mine = ids[start:start + length]
                        at.append(i)
                        out.append((n, start, length, zlib.crc32(mine.tobytes()), part, seen[length]))
                        seen[length] += 1
                        if with_ids:
                            each.append(mine)
                if at:
                    columns = zip(*out, strict=True)
                    arrays = [rows.column(0).take(pa.array(at)),
                              *(pa.array(c, f.dataType == T.IntegerType() and pa.int32() or pa.int64())
                                for c, f in zip(columns, fields[1:7], strict=True))]
                    if with_ids:
                        arrays.append(pa.array([m.astype(np.int64) for m in each], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: their places in sequences of at most ``capacity`` ids."""
    spark = ready(docs.sparkSession)
    found = stored(pieces(docs, path, capacity, end_id, with_ids, id_col, text_col), "pieces")
    by_task = found.groupBy("part", "length").agg(F.count("*").alias("n"))
    # One row for each length up to the capacity.
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan(counts, capacity)
    table: dict[int, np.ndarray] = {}
    for s in slots:
        table.setdefault(s.length, []).append((s.first, s.each, s.sequence, s.offset))
    shared = spark.sparkContext.broadcast({length: np.array(rows, np.int64).T for length, rows in table.items()})
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = by_task.select("part", "length", F.coalesce(before, F.lit(0)).alias("base"))
    numbered = found.join(bases, ["part", "length"]).withColumn("number", F.col("number") + F.col("base"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = T.StructType([*(found.schema[n] for n in names), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                first, each, base, start = shared.value[size]
                slot = np.searchsorted(first, number[at], "right") - 1
                seat, place = np.divmod(number[at] - first[slot], each[slot])
                sequence[at], offset[at] = base[slot] + seat, start[slot] + place * size
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], schema.names)

    return numbered.select(*names, "number").mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of the result of ``pack(..., with_ids=True)``; a sequence has at most the capacity."""
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
