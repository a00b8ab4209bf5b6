"""Embedding whitening with components from contour integration.

An entry c counts as the whole number floor(1024 * c) + 100000. Sums and
centred products of these are added as whole numbers, in float blocks that are
small enough to be exact and then as decimals, so that the covariance is the
same in every run and rounded once. Only it, one matrix of the vectors' width,
reaches the driver; ``feast.largest`` finds its leading components, and tasks
project the rows on them. Four passes read the stored whole numbers: width and
sums, centred products, covariance of the whitened rows, result.

Defined cases: vectors that are null, empty, or hold null or non-finite
entries, or entries whose whole number has more than 62 bits, take no part. All
vectors need one width: the one that most rows have (the larger one of two as
frequent) is taken and rows of another width take no part. Repeated rows and
ids and null ids each give their own rows. A component without variance (below
1e-12 of the trace) can't be whitened and is left out, so that equal vectors,
a single one and an empty table give no rows. ``deviation`` is null where it
doesn't fit 64 bits. Vectors of any width are read whole; the matrix grows with
the square of the width. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.llm.common import ready, stored
from transitlens.llm.feast import largest

SCALE, OFFSET = 1024, 100_000
#: A component's variance is at least this part of the trace.
LEAST_SHARE = 1e-12
#: Rows that a task turns into matrices at once.
ROWS = 4096


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and ``x`` array<bigint> of the rows that take part, of any width."""
    v = F.col(vec_col)
    fits = F.forall(v, lambda c: c.isNotNull() & (F.abs(F.lit(float(SCALE)) * c.cast("double")) < float(2 ** 62)))
    return (vectors.filter(v.isNotNull() & (F.size(v) > 0) & F.coalesce(fits, F.lit(False)))
            .select(F.col(id_col).alias("vec_id"),
                    F.transform(v, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")) + F.lit(OFFSET)).alias("x")))


def _parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, whole-number matrix) of at most ROWS rows."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            part = batch.slice(first, ROWS)
            yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _largest(m: np.ndarray) -> int:
    return max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))


def _centred(x: np.ndarray, centre: list[int]) -> np.ndarray:
    """x - centre as whole numbers of any size."""
    if max(_largest(x), max(map(abs, centre))) < 2 ** 61:
        return x - np.array(centre, np.int64)
    return x.astype(object) - np.array(centre, object)


def _products(y: np.ndarray) -> list[list[int]]:
    """Exact y^T y."""
    top, width = _largest(y), y.shape[1]
    rows = 2 ** 53 // top ** 2 if top else len(y)
    if rows == 0:
        y = y.astype(object)
        return (y.T @ y).tolist()
    floats = y.astype(np.float64)
    total = np.zeros((width, width), object)
    for first in range(0, len(y), rows):
        block = floats[first:first + rows]
        total += (block.T @ block).astype(np.int64)
    return total.tolist()


def _sums(rows: DataFrame, width: int) -> list[int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for _, x in _parts(batches, width):
            y = x if _largest(x) * len(x) < 2 ** 62 else x.astype(object)
            total = [a + int(b) for a, b in zip(total, y.sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(map(Decimal, total), pa.decimal128(38, 0))], ["i", "s"])

    found = rows.select("vec_id", "x").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    return [int(r.s) for r in sorted(found, key=lambda r: r.i)]


def _covariance(rows: DataFrame, n: int, sums: list[int]) -> tuple[np.ndarray, Fraction]:
    """The covariance, every entry rounded once, and its exact trace."""
    width = len(sums)
    centre = [round(Fraction(s, n)) for s in sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for _, x in _parts(batches, width):
            total += np.array(_products(_centred(x, centre)), object)
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(t)) for t in total[i, j]], pa.decimal128(38, 0))],
            ["i", "j", "s"])

    found = (rows.select("vec_id", "x").mapInArrow(run, "i int, j int, s decimal(38,0)")
             .groupBy("i", "j").agg(F.sum("s").alias("s")).toLocalIterator())
    left = [s - n * c for s, c in zip(sums, centre, strict=True)]
    matrix, trace = np.zeros((width, width)), Fraction(0)
    for r in found:
        entry = Fraction(n * int(r.s) - left[r.i] * left[r.j], n * n)
        matrix[r.i, r.j] = matrix[r.j, r.i] = float(entry)
        trace += entry if r.i == r.j else 0
    return matrix, trace


def _identity_error(rows: DataFrame, n: int, project, width: int, k: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for _, x in _parts(batches, width):
            w = project(x)
            first += w.sum(axis=0)
            second += w.T @ w
        both = np.concatenate([first[None], second])
        i, j = np.indices(both.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(both.ravel())], ["i", "j", "s"])

    both = np.zeros((k + 1, k))
    for r in rows.select("vec_id", "x").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        both[r.i, r.j] = r.s / n
    return float(np.abs(both[1:] - np.outer(both[0], both[0]) - np.eye(k)).max())


def whiten(vectors: DataFrame, k: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row for each vector and each of the ``k`` leading components:

    vec_id, component (from 1), n (vectors), deviation (sum over dimensions of
    (n * x - S)^2, S the sums), whitened, explained (share of the trace),
    identity_error (of the whole result).
    """
    spark = ready(vectors.sparkSession)
    id_type = vectors.schema[id_col].dataType
    schema = T.StructType([T.StructField("vec_id", id_type), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
                           T.StructField("identity_error", T.DoubleType())])
    rows = stored(whole_vectors(vectors, id_col, vec_col), "whole-vectors")
    widths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).take(1)
    if not widths:
        return spark.createDataFrame([], schema)
    width, n = widths[0]["width"], widths[0]["count"]
    rows = rows.filter(F.size("x") == width)
    sums = _sums(rows, width)
    matrix, trace = _covariance(rows, n, sums)
    values, directions = largest(matrix, k)
    kept = values > LEAST_SHARE * float(trace)
    values, directions = values[kept], directions[:, kept]
    if not len(values):
        return spark.createDataFrame([], schema)
    centre = [round(Fraction(s, n)) for s in sums]
    left = [s - n * c for s, c in zip(sums, centre, strict=True)]
    rest = np.array([float(Fraction(t, n)) for t in left])
    scaled = directions / np.sqrt(values)

    def project(x: np.ndarray) -> np.ndarray:
        return (_centred(x, centre).astype(np.float64) - rest) @ scaled

    def deviations(x: np.ndarray) -> list[int | None]:
        y = _centred(x, centre)
        if (n * (_largest(y) + 1)) ** 2 * width < 2 ** 62:
            return ((n * y - np.array(left, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((n * y.astype(object) - np.array(left, object)) ** 2).sum(axis=1)
        return [int(e) if e < 2 ** 63 else None for e in exact]

    error = _identity_error(rows, n, project, width, len(values))
    explained = [float(e / float(trace)) for e in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = len(explained)
        for ids, x in _parts(batches, width):
            at = pa.array(np.repeat(np.arange(len(ids)), count))
            yield pa.RecordBatch.from_arrays(
                [ids.take(at), pa.array(np.tile(np.arange(1, count + 1), len(ids)), pa.int32()),
                 pa.array(np.full(len(at), n), pa.int64()), pa.array(deviations(x), pa.int64()).take(at),
                 pa.array(project(x).ravel()), pa.array(np.tile(explained, len(ids))),
                 pa.array(np.full(len(at), error))], schema.names)

    return rows.select("vec_id", "x").mapInArrow(run, schema)
