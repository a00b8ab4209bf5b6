"""Exact top-k search by inner product with multi-resolution segment bounds.

Vectors are whole numbers, floor(1024 * x). For a segment of length L the
distance of two vectors is at least L * ((difference of their segment means)^2
+ (difference of their segment deviations)^2). With the lengths of the vectors
known, a lower bound on distance is an upper bound on the inner product:
sum over segments of L * (mean * mean' + deviation * deviation').

Queries come in blocks of at most ``QUERY_BLOCK`` rows, which is the bound on
what is broadcast; every block meets all candidates in one pass. A task takes
its candidates in batches: pairs whose bound at one segment is below the
query's tenth best score so far are out, the rest is bounded with 4 and then
16 segments, and the exact score is computed for those that are left. Each
task returns its best k for each query; these are merged by query.

Defined cases: null vectors, empty ones, and ones that hold null or non-finite
components take no part, nor do rows without an id; rows that share the
query's id are the query's own row, and each of them is a query with a list of
its own; very long vectors are taken whole; only vectors of equal length are compared;
ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.llm.common import ready, stored

#: Segments at each resolution, coarse to fine.
SEGMENTS = (1, 4, 16)
QUERY_BLOCK = 16_384
SCALE = 1024
RESULT = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("query_row", T.LongType()),
                       T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and ``v`` array<bigint> of the rows that take part."""
    x = F.col(vec_col)
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    v = F.transform(x, lambda c: F.floor(F.lit(SCALE) * c.cast("double")))
    return (vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & good)
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")))


def segment_stats(matrix: np.ndarray, segments: int) -> np.ndarray:
    """Rows of (sqrt(L) * mean, sqrt(L) * deviation) of each segment: their products are the bound."""
    parts = np.array_split(matrix, min(segments, matrix.shape[1]), axis=1)
    out = [np.sqrt(p.shape[1]) * s for p in parts for s in (p.mean(axis=1), p.std(axis=1))]
    return np.stack(out, axis=1)


class Block:
    """Query vectors of one length with their statistics and best scores so far."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, matrix: np.ndarray, k: int):
        self.ids, self.rows, self.matrix, self.k = ids, rows, matrix.astype(np.float64), k
        self.stats = [segment_stats(self.matrix, s) for s in SEGMENTS]
        # Scores are exact whole numbers in doubles; larger ones go through whole-number products.
        self.exact = matrix
        self.norm = np.abs(self.matrix).max(axis=1) if len(ids) else np.zeros(0)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
        self.least = np.full(len(ids), -np.inf)

    def add(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        """Take a batch of candidates."""
        floats = matrix.astype(np.float64)
        # Rounding of the bounds: far below this part of the largest possible product.
        slack = 1e-9 * (1 + self.norm[:, None] * np.abs(floats).max(axis=1)[None, :] * matrix.shape[1])
        bound = self.stats[0] @ segment_stats(floats, SEGMENTS[0]).T + slack
        q, c = np.nonzero((bound >= self.least[:, None]) & (self.ids[:, None] != ids[None, :]))
        for stats, segments in zip(self.stats[1:], SEGMENTS[1:], strict=True):
            if not len(q):
                return
            theirs = segment_stats(floats, segments)
            ok = np.concatenate([np.einsum("ij,ij->i", stats[q[i:i + 65536]], theirs[c[i:i + 65536]])
                                 for i in range(0, len(q), 65536)]) + slack[q, c] >= self.least[q]
            q, c = q[ok], c[ok]
        if not len(q):
            return
        scores = np.concatenate([np.einsum("ij,ij->i", self.exact[q[i:i + 65536]], matrix[c[i:i + 65536]])
                                 for i in range(0, len(q), 65536)])
        starts = np.flatnonzero(np.diff(q, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(q)], strict=True):
            i = q[a]
            old_scores, old_ids = self.best[i]
            s, v = np.concatenate([old_scores, scores[a:b]]), np.concatenate([old_ids, ids[c[a:b]]])
            keep = np.lexsort((v, -s))[:self.k]
            self.best[i] = s[keep], v[keep]
            if len(keep) == self.k:
                self.least[i] = s[keep[-1]]


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, rows, matrix) for each vector length in a batch of (vec_id, row, v)."""
    ids, numbers = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    lists = batch.column(2)
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield ids[rows], numbers[rows], flat[ends[rows][:, None] + np.arange(n)]


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best of all other rows.

    Queries are the rows whose id is divisible by ``every``.
    """
    spark = ready(vectors.sparkSession)
    # Rows are numbered as they are written, so that the numbers hold for every read.
    numbered = whole_vectors(vectors, id_col, vec_col).select("vec_id", F.monotonically_increasing_id().alias("row"), "v")
    rows = stored(numbered, "vectors")
    queries = rows.filter(F.col("vec_id") % every == 0)
    # Blocks by hash of id and row, each well below QUERY_BLOCK rows.
    blocks = max(1, -(-queries.count() * 2 // QUERY_BLOCK))
    found = None
    for n in range(blocks):
        mine = queries.filter(F.pmod(F.xxhash64("vec_id", "row"), F.lit(blocks)) == n).toArrow().combine_chunks()
        shared = spark.sparkContext.broadcast([] if not mine.num_rows else [
            x for b in mine.to_batches() for x in _matrices(b)])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            by_length: dict[int, list[Block]] = {}
            for ids, numbers, matrix in shared.value:
                for a in range(0, len(ids), 1024):
                    some = slice(a, a + 1024)
                    by_length.setdefault(matrix.shape[1], []).append(Block(ids[some], numbers[some], matrix[some], k))
            for batch in batches:
                for ids, _, matrix in _matrices(batch):
                    for a in range(0, len(ids), 1024):
                        for block in by_length.get(matrix.shape[1], ()):
                            block.add(ids[a:a + 1024], matrix[a:a + 1024])
            for group in by_length.values():
                for block in group:
                    n_best = [len(s) for s, _ in block.best]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(block.ids, n_best)), pa.array(np.repeat(block.rows, n_best)),
                         pa.array(np.concatenate([v for _, v in block.best])),
                         pa.array(np.concatenate([s for s, _ in block.best]))], RESULT.names)

        part = rows.mapInArrow(run, RESULT)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
