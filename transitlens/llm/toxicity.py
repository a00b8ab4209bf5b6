"""Toxicity by non-negative positive-unlabelled learning.

A classifier learns from documents that are known to be toxic and from
unlabelled text, some of which is toxic too. Its risk is estimated as

    prior * E[loss(+g) | toxic] + max(0, E[loss(-g)] - prior * E[loss(-g) | toxic])

with g the score before the sigmoid and the logistic loss: the negatives' risk
is that of unlabelled text less the share that toxic text has in it, held at 0
where this turns negative in a batch. The prior is the
share of toxic documents among labelled ones. Features are the distinct words
of the whole text, hashed; documents alone decide on a score, never labels,
language, source or id.

Training is on a bounded sample: ``MOST_POSITIVE`` toxic and
``MOST_UNLABELLED`` other documents at most, drawn by a hash of the id. It runs
on the driver in numpy; what executors send is the sampled documents' hashed
words, and what they get is one weight for each of ``1 << BITS`` hashes.

Defined cases: null and empty texts have no words and score as the bias says;
a document labelled more than once is toxic if any label says so; null labels
count as none; repeated rows and null ids give one row each; without any toxic
example every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.llm.common import id_crc, ready

BITS = 18
MOST_POSITIVE = 4_000
MOST_UNLABELLED = 16_000
WORD = re.compile(r"\w+")
#: Distinct words that a Python worker keeps the hash of. A full table is emptied.
WORDS_KEPT = 400_000
#: A hash has a weight if its share of toxic documents differs from its share of
#: unlabelled ones by so many standard errors, and if so many sampled documents have it.
#: No negative labels are needed for this.
LEAST_SIGNIFICANT = 4.0
LEAST_DOCUMENTS = 5


class Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        got = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) >> (32 - BITS)
        return got


_HASHES = Hashes()


def features(text: str | None) -> np.ndarray:
    """The distinct hashes of a text's words, in order."""
    words = set(WORD.findall((text or "").lower()))
    return np.unique(np.fromiter((_HASHES[w] for w in words), np.int32, len(words)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Rows:
    """Documents as sets of feature numbers, in one array."""

    def __init__(self, rows: list[np.ndarray]):
        self.starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        self.flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row number in ``which``, feature) for every feature of these rows."""
        sizes = self.starts[which + 1] - self.starts[which]
        place = np.repeat(self.starts[which] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        return np.repeat(np.arange(len(which)), sizes), self.flat[place]


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 1000,
          batch: int = 512, rate: float = 0.05, decay: float = 1e-4, seed: int = 2) -> tuple[np.ndarray, float]:
    """Weights and bias of the non-negative risk's minimum, by Adam steps on batches of both kinds."""
    weights, bias = np.zeros(1 << BITS, np.float64), 0.0
    if not positive or not unlabelled:
        return weights, float("-inf")
    in_p, in_u = (np.bincount(np.concatenate(x), minlength=1 << BITS) for x in (positive, unlabelled))
    n_p, n_u = len(positive), len(unlabelled)
    share = (in_p + in_u + 1) / (n_p + n_u + 2)
    error = np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    used = np.flatnonzero((np.abs(in_p / n_p - in_u / n_u) >= LEAST_SIGNIFICANT * error)
                          & (in_p + in_u >= LEAST_DOCUMENTS))
    number = np.full(1 << BITS, -1)
    number[used] = np.arange(len(used))
    inner = lambda rows: Rows([x[x >= 0] for x in (number[r] for r in rows)])
    p, u = inner(positive), inner(unlabelled)
    w = np.zeros(len(used) + 1)  # the last one is the bias
    w[-1] = np.log(prior / (1 - prior))
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    random = np.random.default_rng(seed)
    while t < steps:
        order = random.permutation(len(u))
        for a in range(0, len(order), batch):
            uu = order[a:a + batch]
            pp = random.integers(0, len(p), min(batch, 4 * len(p)))
            (pr, pf), (ur, uf) = p.take(pp), u.take(uu)
            gp = np.bincount(pr, w[pf], len(pp)) + w[-1]
            gu = np.bincount(ur, w[uf], len(uu)) + w[-1]
            # Of the logistic loss log(1 + exp(-z)): slopes of loss(+g) and loss(-g).
            negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            if negative >= 0:
                sp = prior * (-sigmoid(-gp) - sigmoid(gp)) / len(pp)
                su = sigmoid(gu) / len(uu)
            else:  # the corrected negatives' risk is 0: only toxic documents pull
                sp, su = -prior * sigmoid(-gp) / len(pp), np.zeros(len(uu))
            grad = np.bincount(pf, sp[pr], len(w)) + np.bincount(uf, su[ur], len(w)) + decay * w
            grad[-1] = sp.sum() + su.sum() if negative >= 0 else 0.0  # the prior alone moves the bias
            t += 1
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    weights[used] = w[:-1]
    return weights, float(w[-1])


def _sampled(docs: DataFrame, labels: DataFrame) -> tuple[list[np.ndarray], list[np.ndarray], float]:
    """Hashed words of the sampled toxic and other documents, and the prior."""
    spark = docs.sparkSession
    learnable = id_crc() % 5 != 0
    toxic = (labels.filter(learnable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    count, positives = toxic.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("long"))).first()
    if not count or not positives:
        return [], [], 0.0
    chosen = lambda share: F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(share * (1 << 40))
    # Nine tenths of the bound, so that chance doesn't pass it; the limit makes it certain.
    ids = (toxic.filter((F.col("toxic") == 1) & chosen(min(1.0, 0.9 * MOST_POSITIVE / positives)))
           .select("doc_id").limit(MOST_POSITIVE).toPandas()["doc_id"])
    known = spark.createDataFrame([(int(i), True) for i in ids], "doc_id long, toxic boolean")
    total = docs.filter(learnable).count()
    share = min(1.0, 0.9 * MOST_UNLABELLED / max(1, total))
    # ``known`` is broadcast: at most MOST_POSITIVE ids.
    rows = (docs.filter(learnable & F.col("doc_id").isNotNull()).select("doc_id", "text")
            .join(F.broadcast(known), "doc_id", "left").withColumn("toxic", F.coalesce("toxic", F.lit(False)))
            .withColumn("drawn", chosen(share)).filter("toxic OR drawn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [features(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(got, pa.binary())],
                                             ["doc_id", "toxic", "drawn", "features"])

    table = rows.mapInArrow(run, "doc_id long, toxic boolean, drawn boolean, features binary").orderBy("doc_id", "features").toArrow()
    kinds = table.column("toxic").to_pylist()
    sets = [np.frombuffer(x, np.int32).astype(np.int64) for x in table.column("features").to_pylist()]
    positive = [s for s, k in zip(sets, kinds, strict=True) if k][:MOST_POSITIVE]
    # Text at large has its share of the documents that are known to be toxic.
    unlabelled = [s for s, d in zip(sets, table.column("drawn").to_pylist(), strict=True) if d][:MOST_UNLABELLED]
    return positive, unlabelled, min(0.9, positives / count)


def score(docs: DataFrame, weights: np.ndarray, bias: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``score``, from 0 to 1, of every row's whole text."""
    spark = ready(docs.sparkSession)
    model = spark.sparkContext.broadcast(weights.astype(np.float32))  # 4 << BITS bytes, whatever the corpus
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = np.array([model.value[features(t)].sum(dtype=np.float64) for t in batch.column(1).to_pylist()]) + bias
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(g), pa.float64())], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Learns only from ids whose crc32 mod 5 isn't 0.
    """
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    weights, bias = train(*_sampled(docs, labels))
    return score(docs, weights, bias).select(
        "doc_id", (id_crc() % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
