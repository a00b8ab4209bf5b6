"""Language-model scoring with a sharded Elias-Fano n-gram trie.

A bigram model with absolute discounting and back-off is learnt from all
training documents: a pair that was seen has probability (count - discount) /
context count, an unseen one its context's back-off weight (the discounted
mass) times the smoothed share of the word alone, and a word after an unseen
context its smoothed share. Shares are (c + 1) / (N + V + 1).

The model is dealt over shards by context, each of bounded size whatever the
corpus, and each shard's trie is built and asked in one task:

1. Words: every batch of documents sends each shard its distinct words, how
   often training documents have them, and the documents that they occur in.
   A shard adds up counts and returns each batch one block of its documents' parts
   of the base score.
2. Pairs: the same with pairs of words, dealt by the first word. A shard builds
   its trie from the pairs of training documents, looks all pairs up, and
   returns each batch a block of its documents' sums of codes, and a block of unseen
   words for each shard of step 1.
3. Unseen words go to the shards of step 1 for their shares.

Contexts with more than a quarter of a shard's tokens are dealt by both words, over as
many shards as they have quarters; their back-off weights are put together after
step 2. A batch knows its documents by their places; its blocks meet its documents'
keys at the end, so that no row is made for a document in a shard.

Words are known by 63-bit hashes.

Defined cases: a null or empty text has the end alone; null ids are held out if
the crc32 of the empty text says so; identical rows have equal scores; without
training documents all words are unseen; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.llm.common import WORD_PATTERN, id_crc, ready, stored
from transitlens.llm.lm_trie import STEPS, Trie, code, mapped

DISCOUNT = 0.75
#: Tokens that a batch gathers before it sends, and that a shard is made for.
BATCH_TOKENS, SHARD_TOKENS = 2_000_000, 3_000_000
WORDS_KEPT = 400_000
#: What stands before the first word and after the last: white space, so that no word has its hash's text.
END = xxhash.xxh3_64_intdigest(b"\n") >> 1
SENT = "shard int, batch long, docs binary, payload binary"


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word) >> 1
        return got


_HASHES = Hashes()


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, compressed."""
    tool = zstandard.ZstdCompressor(level=1)
    out = []
    for a in arrays:
        raw = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() if len(a) else b""
        raw = tool.compress(raw)
        out.append(np.array([len(a), a.itemsize, len(raw)], np.int64).tobytes() + raw)
    return b"".join(out)


def unpack(block: bytes) -> list[np.ndarray]:
    tool, out, at = zstandard.ZstdDecompressor(), [], 0
    while at < len(block):
        n, size, length = map(int, np.frombuffer(block, np.int64, 3, at))
        raw = tool.decompress(block[at + 24:at + 24 + length], max_output_size=max(1, n * size)) if n else b""
        planes = np.frombuffer(raw, np.uint8).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{size}"))
        at += 24 + length
    return out


def tokens(text: str | None) -> list[int]:
    """Hashes of a text's words, A-Z in lower case, and of the end."""
    # bytes: lower() changes A-Z alone, split() is at the white space \x20 and \x09-\x0D.
    return [_HASHES[w] for w in (text or "").encode("utf-8", "surrogatepass").lower().split()] + [END]


def _deltas(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=0)


def _places(places: np.ndarray) -> np.ndarray:
    return _deltas(places.astype(np.int64)).astype(np.uint32)


def _starts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))


def _payload(training: np.ndarray, word: np.ndarray, first: np.ndarray | None, doc: np.ndarray) -> tuple[bytes, bytes]:
    """One shard's part of a batch: its documents' places; its distinct words or pairs and where they occur."""
    order = np.argsort(word, kind="stable") if first is None else np.lexsort((word, first))
    word, doc = word[order], doc[order]
    if first is None:
        new, contexts = _starts(word), []
    else:
        first = first[order]
        new = np.union1d(_starts(word), _starts(first))
        begins = _starts(first[new])
        contexts = [_deltas(first[new][begins]), np.diff(np.append(begins, len(new))).astype(np.uint32)]
    here, doc_place = np.unique(doc, return_inverse=True)
    seen = np.diff(np.append(new, len(word)))
    learnt = np.add.reduceat(training[doc].astype(np.int64), new)
    words = word[new] if contexts else _deltas(word[new])
    return pack(_places(here)), pack(words, seen.astype(np.uint32), learnt.astype(np.uint32), doc_place.astype(np.uint32), *contexts)


def _sent(training: np.ndarray, flat: np.ndarray, doc: np.ndarray, shards: int, pairs: bool,
          hot: dict[int, tuple[int, int]]) -> Iterator[tuple[int, bytes, bytes]]:
    """What a batch sends to each shard: (shard, documents' places, payload).

    ``flat`` has the tokens of all documents, ``doc`` the document of each;
    ``hot`` the first shard and the number of shards of each hot context.
    Every document ends with ``END``, which is the context of the next one's
    first word as well.
    """
    first = np.concatenate([[END], flat[:-1]]) if pairs else flat
    shard = first % shards
    for word, (begin, parts) in hot.items():
        mine = first == word
        shard[mine] = begin + flat[mine] % parts
    order = np.argsort(shard.astype(np.uint16) if shard.max() < 1 << 16 else shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        mine = order[a:b]
        yield int(shard[mine[0]]), *_payload(training, flat[mine], first[mine] if pairs else None, doc[mine])


def _sender(shards: int, pairs: bool, hot: dict[int, tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0

        def sent(shard: int, docs: bytes, payload: bytes) -> pa.RecordBatch:
            batch = ((task << 24) + number) * 2 + pairs
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([batch], pa.int64()), pa.array([docs], pa.binary()),
                                               pa.array([payload], pa.binary())], ["shard", "batch", "docs", "payload"])

        def flush() -> Iterator[pa.RecordBatch]:
            lengths = [len(t) for t in held]
            flat = np.concatenate(held)
            doc = np.repeat(np.arange(len(held), dtype=np.uint32), lengths)
            # The documents' keys wait under a number of their own.
            yield sent(-1 - (task * 997 + number) % (1 << 30), np.array(keys, np.int64).tobytes(), b"")
            for row in _sent(np.array(training, bool), flat, doc, shards, pairs, hot):
                yield sent(*row)

        held, keys, training, n = [], [], [], 0
        for batch in batches:
            for key, learn, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                held.append(np.array(tokens(text), np.int64))
                keys.append(key)
                training.append(learn)
                n += len(held[-1])
                if n >= BATCH_TOKENS:
                    yield from flush()
                    held, keys, training, n, number = [], [], [], 0, number + 1
        if held:
            yield from flush()

    return run


def _received(table: pa.Table, pairs: bool):
    """Distinct values of all batches with their training counts, and each batch's part.

    Values are words, or pairs (place among ``contexts`` << 32 | place among
    ``words``). A part has its batch and the documents' places there, the places of
    its values among the distinct ones, how often each occurs, and the document of
    each occurrence.
    """
    got = [((batch.as_py(), unpack(memoryview(docs.as_buffer()))[0]), unpack(memoryview(payload.as_buffer())))
           for batch, docs, payload in zip(table.column("batch"), table.column("docs"), table.column("payload"), strict=True)]
    flat = np.concatenate([x[0].view(np.int64) if pairs else np.cumsum(x[0].view(np.int64)) for _, x in got])
    words, places = np.unique(flat, return_inverse=True)
    del flat
    contexts, distinct = np.zeros(0, np.int64), words
    if pairs:
        contexts, rank = np.unique(np.concatenate([np.cumsum(x[4].view(np.int64)) for _, x in got]), return_inverse=True)
        both = np.repeat(rank, np.concatenate([x[5] for _, x in got])) << 32
        both |= places
        distinct, places = np.unique(both, return_inverse=True)
        del both, rank
    places = places.astype(np.int32)
    total = np.bincount(places, np.concatenate([x[2] for _, x in got]), len(distinct)).astype(np.int64)
    at, parts = 0, []
    for (batch, docs), x in got:
        parts.append((batch, docs, places[at:at + len(x[0])], x[1], x[3]))
        at += len(x[0])
    return words, contexts, distinct, total, parts


def _rows(kind: str, **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    full = {"key": pa.int64(), "total": pa.float64(), "known": pa.int64(), "shard": pa.int32(), "block": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([kind] * n, pa.string())] + [
        pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in full.items()], ["kind", *full])


ROWS = "kind string, key long, total double, known long, shard int, block binary"


def _kept_keys(table: pa.Table) -> pa.Table:
    """The keys of batches' documents."""
    return pa.Table.from_batches([_rows("keys", key=table.column("batch").to_pylist(), block=table.column("docs").to_pylist())])


def _word_shard(table: pa.Table) -> pa.Table:
    """Step 1. ``doc``: a batch's documents, their sums of log10(c + 1) and numbers of known words. ``words``: the shard's counts."""
    if table.column("shard")[0].as_py() < 0:
        return _kept_keys(table)
    distinct, _, _, total, parts = _received(table, False)
    logs, known = np.log10(total + 1.0), total > 0
    out = []
    for batch, docs, places, seen, doc in parts:
        places = np.repeat(places, seen)
        out.append(_rows("doc", key=[batch], block=[pack(docs, np.bincount(doc, logs[places], len(docs)),
                                                         np.bincount(doc, known[places], len(docs)).astype(np.uint32))]))
    have = distinct[known]
    out.append(_rows("words", key=[int(total.sum())], known=[len(have)], shard=[int(table.column("shard")[0].as_py())],
                     block=[pack(_deltas(have), total[known])]))
    large = np.flatnonzero(total > SHARD_TOKENS // 4)
    # Bounded: each stands for a quarter of a shard's tokens.
    out.append(_rows("hot", key=distinct[large], known=total[large]))
    return pa.Table.from_batches(out)


def _pair_shard(hot: list[tuple[int, int]], shards: int):
    """Step 2, with the first shard and the count of each hot context.

    ``codes``: a batch's documents and their sums of codes. ``unseen``: the unseen words for a word shard, with batch and
    document. ``mass``: of hot contexts.
    """
    begins = [begin for begin, _ in hot]

    def run(table: pa.Table) -> pa.Table:
        shard = int(table.column("shard")[0].as_py())
        if shard < 0:
            return _kept_keys(table)
        number = bisect_right(begins, shard) - 1  # of a hot context, or -1
        words, contexts, distinct, total, parts = _received(table, True)
        learnt = np.flatnonzero(total)
        context, word = distinct[learnt] >> 32, distinct[learnt] & 0xFFFFFFFF
        names, first, size = np.unique(context, return_index=True, return_counts=True)
        known, successor = np.unique(word, return_inverse=True)
        pointers = np.append(first, len(learnt)).astype(np.int64)
        count = np.add.reduceat(total[learnt], first) if len(learnt) else np.zeros(0, np.int64)
        whole = np.full(len(names), hot[number][1]) if number >= 0 else count
        share = (total[learnt] - DISCOUNT) / np.repeat(whole, size)
        # A hot context's weight is known when all its shards are done.
        backoff = np.zeros(len(names)) if number >= 0 else np.log10(DISCOUNT * size / count)
        trie = Trie(mapped(Trie.build(words[known], contexts[names], pointers, successor, code(np.log10(share)), code(backoff))))
        place, rank = trie.search(words, contexts, distinct)
        del context, word, successor, learnt
        cost = np.where(place >= 0, trie.codes[np.maximum(place, 0)] if len(trie.codes) else 0,
                        np.where(rank >= 0, trie.backoffs[np.maximum(rank, 0)] if len(trie.backoffs) else 0, 0)).astype(np.float64)
        out = [_rows("mass", key=[number], known=[int(size.sum())])] if number >= 0 else []
        lost = place < 0
        second = words[distinct & 0xFFFFFFFF]
        gone = []
        for batch, docs, places, seen, doc in parts:
            places = np.repeat(places, seen)
            out.append(_rows("codes", key=[batch], block=[pack(docs, np.bincount(doc, cost[places], len(docs)).astype(np.uint64))]))
            at = np.flatnonzero(lost[places])
            gone.append((second[places[at]], np.cumsum(docs, dtype=np.int64)[doc[at]].astype(np.uint32), np.full(len(at), batch)))
        unseen = [np.concatenate(x) for x in zip(*gone, strict=True)]
        home = unseen[0] % shards
        order = np.argsort(home, kind="stable")
        cuts = np.flatnonzero(np.diff(home[order], prepend=-1))
        some = [(int(home[order[a]]), pack(*(x[order[a:b]] for x in unseen))) for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True)]
        out.append(_rows("unseen", key=[number] * len(some), shard=[s for s, _ in some], block=[x for _, x in some]))
        return pa.Table.from_batches(out)

    return run


def _unseen_shard(norm: float, weights: dict[int, float]):
    """Step 3: ``codes`` of the unseen words."""
    def run(table: pa.Table) -> pa.Table:
        have, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        jobs = []
        for kind, number, block in zip(*(table.column(c).to_pylist() for c in ("kind", "key", "block")), strict=True):
            if kind == "words":
                v, counts = unpack(block)
                have = np.cumsum(v.view(np.int64))
            else:
                jobs.append((number, unpack(block)))
        sums: list[pa.RecordBatch] = []
        found = []
        for number, (words, place, batch) in jobs:
            words = words.view(np.int64)
            at = np.minimum(np.searchsorted(have, words), max(0, len(have) - 1))
            c = np.where(have[at] == words, counts[at], 0) if len(have) else np.zeros(len(words))
            found.append((batch.view(np.int64), place, code(np.log10((c + 1.0) / norm)).astype(np.float64) + weights.get(number, 0.0)))
        if found:
            batch, place, cost = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(batch, kind="stable")
            cuts = _starts(batch[order])
            for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
                docs, here = np.unique(place[order[a:b]], return_inverse=True)
                total = np.bincount(here, cost[order[a:b]], len(docs)).astype(np.uint64)
                sums.append(_rows("codes", key=[int(batch[order[a]])], block=[pack(_places(docs), total)]))
        return pa.Table.from_batches(sums or [_rows("codes", key=[], block=[])])

    return run


def _by_document(table: pa.Table) -> pa.Table:
    """(key, total, known, codes) of the documents of a batch, from its blocks."""
    blocks = list(zip(table.column("kind").to_pylist(), table.column("block").to_pylist(), strict=True))
    keys = np.frombuffer(next(b for kind, b in blocks if kind == "keys"), np.int64)
    total, known, codes = np.zeros(len(keys)), np.zeros(len(keys), np.int64), np.zeros(len(keys))
    for kind, block in blocks:
        if kind == "keys":
            continue
        docs, *x = unpack(block)
        at = np.cumsum(docs, dtype=np.int64)  # no document is there twice
        if kind == "doc":
            total[at] += x[0].view(np.float64)
            known[at] += x[1]
        else:
            codes[at] += x[0]
    return pa.table({"key": keys, "total": total, "known": known, "codes": codes})


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    Documents whose crc32(id) mod ``folds`` is ``held`` are scored but not learnt from.
    """
    spark = ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    held_out = id_crc() % folds == held
    key = F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")))
    facts = stored(rows.select(key.alias("key"), "doc_id", held_out.alias("held_out"), (
        F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)) + 1).cast("long").alias("n_tokens")), "lm-documents")
    size = facts.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, -(-size // SHARD_TOKENS))
    texts = rows.select(key.alias("key"), (~held_out).alias("training"), "text")

    def step(pairs: bool, hot: dict[int, tuple[int, int]], answer, name: str) -> DataFrame:
        sent = texts.mapInArrow(_sender(shards, pairs, hot), SENT)
        return stored(sent.groupBy("shard").applyInArrow(answer, ROWS), name)

    words = step(False, {}, _word_shard, "lm-words")
    train_tokens, vocabulary = (x or 0 for x in words.filter("kind = 'words'").agg(F.sum("key"), F.sum("known")).first())
    norm = float(train_tokens + vocabulary + 1)
    large = [(r["key"], r["known"]) for r in words.filter("kind = 'hot'").orderBy("key").collect()]
    hot, end = {}, shards
    for word, count in large:
        hot[word] = end, -(-4 * count // SHARD_TOKENS)
        end += hot[word][1]
    pairs = step(True, hot, _pair_shard([(hot[word][0], count) for word, count in large], shards), "lm-pairs")
    mass = pairs.filter("kind = 'mass'").groupBy("key").agg(F.sum("known").alias("n")).collect()
    weights = {r["key"]: float(code(np.log10(np.array(max(1, r["n"]) * DISCOUNT / large[r["key"]][1])))) for r in mass}
    asked = words.filter("kind = 'words'").unionByName(pairs.filter("kind = 'unseen'"))
    unseen = asked.groupBy("shard").applyInArrow(_unseen_shard(norm, weights), ROWS)
    blocks = words.filter("kind IN ('keys', 'doc')").unionByName(pairs.filter("kind IN ('keys', 'codes')")).unionByName(unseen)
    sums = blocks.select("kind", "key", "block").groupBy("key").applyInArrow(_by_document, "key long, total double, known long, codes double")
    sums = sums.groupBy("key").agg(F.sum("total").alias("total"), F.sum("known").alias("known"), F.sum("codes").alias("codes"))
    same = facts.groupBy("key").agg(F.count("*").alias("rows")).join(sums, "key").withColumnRenamed("key", "_key")
    return facts.join(same, F.col("key") == F.col("_key")).select(
        "doc_id", "held_out", "n_tokens", (F.col("known") / F.col("rows")).cast("long").alias("n_known"),
        F.lit(int(train_tokens)).cast("long").alias("train_tokens"),
        (F.col("total") / F.col("rows") - F.col("n_tokens") * F.lit(float(np.log10(norm)))).alias("base_score"),
        (-F.col("codes") / F.col("rows") / STEPS).alias("score"))
