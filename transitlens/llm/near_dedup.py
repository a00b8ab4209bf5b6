"""Near-duplicate documents by Order MinHash.

A sketch of a text takes the ``ELL`` least of its occurrence-labelled k-mers
under one hash and keeps them in text order, so that two texts
share it as often as their edit similarity is high. ``SKETCHES`` of them are
made for each text, of k-mers of ``K`` words, for texts of up to ``SHORT`` words
of ``SHORT_K`` words, and of both kinds from ``LONG`` to ``SHORT`` words, so that
any two similar texts have a kind in common. Two texts are candidates if they
share a sketch. Candidates are
aligned word by word in a band as wide as the allowed distance, and are near
duplicates if the alignment shows a similarity (1 - distance / longer length)
of ``SIMILARITY`` or more. A class is a connected group of near duplicates.

Words are runs of letters and digits in lower case. Texts with the same words
are one node and count as copies without being paired. Before any alignment the
lengths, the parities of the words' counts in ``PARITIES`` slots and the counts
in ``TALLIES`` groups of slots must allow that two texts are similar. Half of
(words that only one of two texts has, and the difference of the lengths) is a
distance that no alignment is below; in a group of slots these words are no fewer
than the parities that differ there and than the difference of the counts. So no
near duplicate is lost.

No group of similar texts is written out as pairs. First each text is
aligned with one text only, the one that leads most of its buckets. Then, while
that closes a part of the open buckets (those with several classes),
each bucket draws a new leader, with which the members of other classes are
aligned. At last all pairs of different classes that share a bucket and
may be similar are aligned, whatever the rounds before found. A pair that shares
several buckets is made in the first of them only. There the bucket's
largest class is compared with the others only, not with itself; buckets with more
than ``HOT`` ** 2 comparisons (a passage that many different texts have) are split
by length: a member is filed under its own range of lengths and the next one,
which near duplicates have in common; what is still above that is dealt over
several keys, each with a part of the members against all.

Defined cases: a null text or one without words is a copy of equal text only;
empty and null texts are in classes of their own, with equal rows of the same id alone; a text of
fewer words than a k-mer has one k-mer; very long texts are sketched whole;
repeated rows are copies; a class is named by its least id, or, if it has none or
other classes have the same, by a negative hash, so that names are unique; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.llm.common import connected_components, keep_only, kept_by, labelled, merged_components, open_members, ready, sliced, stored, temporary

K, SHORT_K = 3, 2
#: Texts of up to SHORT words have sketches of SHORT_K words, those of LONG words or more of K words.
SHORT, LONG = 64, 48
ELL = 2
SKETCHES = 32
SIMILARITY = 0.8
PARITIES = 2048
#: Groups of slots, half of a word of parities each, whose counts are kept.
TALLIES = PARITIES // 32
#: A bucket may take the square of this in comparisons before it is split.
HOT = 1000
#: Rounds of drawn leaders go on while they bring the members of open buckets below this share.
CLOSED = 0.8
WORD = re.compile(r"[^\W_]+")
WORDS_KEPT = 200_000
#: Words of texts that are sketched together.
CHUNK = 200_000
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


class Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return got


_HASHES = Hashes()
kept_by("near_dedup", _HASHES.clear)


def word_hashes(text: str | None) -> np.ndarray:
    words = WORD.findall((text or "").lower())
    return np.fromiter((_HASHES[w] for w in words), np.uint64, len(words))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def labelled_kmers(words: list[np.ndarray], k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the occurrence-labelled k-mers of texts with words, one after the other, and where each text starts."""
    padded = [w if len(w) >= k else np.concatenate([w, np.zeros(k - len(w), np.uint64)]) for w in words]
    counts = np.array([len(w) - k + 1 for w in padded])
    flat = np.concatenate(padded)
    first = np.concatenate([[0], np.cumsum([len(w) for w in padded])[:-1]])
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    text = np.repeat(np.arange(len(words)), counts)
    at = np.arange(counts.sum()) - starts[text] + first[text]
    with np.errstate(over="ignore"):
        h = flat[at]
        for n in range(1, k):
            h = h * np.uint64(0x100000001B3) + mix(flat[at + n], n)
        h = mix(h)
        # The n-th occurrence of a k-mer in a text has a hash of its own.
        key = h ^ mix(text.astype(np.uint64), 99)
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
        run = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        nth = np.empty(len(order), np.uint64)
        nth[order] = run
        return mix(h + nth * np.uint64(0xD6E8FEB86659FD93)), starts


def sketch(words: list[np.ndarray], k: int = K, ell: int = ELL, sketches: int = SKETCHES) -> np.ndarray:
    """A row of sketch hashes for each text; every text has a word."""
    h, starts = labelled_kmers(words, k)
    counts = np.diff(np.append(starts, len(h)))
    out = np.empty((len(words), sketches), np.uint64)
    texts = np.arange(len(words))
    for j in range(sketches):
        x = mix(h, j + 1)
        place = np.full((len(words), ell), len(h), np.int64)
        for n in range(ell):
            least = np.minimum.reduceat(x, starts)
            hits = np.flatnonzero(x == np.repeat(least, counts))
            who = np.searchsorted(starts, hits, side="right") - 1
            one = np.concatenate([[True], who[1:] != who[:-1]])
            hits, who = hits[one], who[one]
            fresh = least[who] != FULL  # else all of the text's k-mers are taken
            place[who[fresh], n] = hits[fresh]
            x[hits] = FULL
        place.sort(axis=1)  # text order
        chosen = np.append(h, np.uint64(0))[place]
        with np.errstate(over="ignore"):
            key = np.full(len(texts), j, np.uint64)
            for n in range(ell):
                key = mix(key * np.uint64(0x100000001B3) + chosen[:, n])
        out[:, j] = key
    return out


def sketches_of(words: list[np.ndarray]) -> list[list[int]]:
    """The sketches of texts with words, of the kinds that their lengths ask for."""
    out: list[list[int]] = [[] for _ in words]
    for k, mine in ((SHORT_K, [i for i, w in enumerate(words) if len(w) <= SHORT]),
                    (K, [i for i, w in enumerate(words) if len(w) >= LONG])):
        if mine:
            for i, made in zip(mine, sketch([words[i] for i in mine], k).view(np.int64).tolist(), strict=True):
                out[i] += made
    return out


def parities(words: list[np.ndarray]) -> np.ndarray:
    """A row of ``PARITIES`` bits for each text: whether it has an odd number of words in a slot."""
    out = np.empty((len(words), PARITIES // 64), np.int64)
    for i, w in enumerate(words):
        odd = np.bincount((w & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
        out[i] = np.packbits(odd.astype(np.uint8)).view(np.int64)
    return out


def tallies(words: list[np.ndarray]) -> np.ndarray:
    """A row of ``TALLIES`` numbers for each text: its words in every group of slots."""
    out = np.empty((len(words), TALLIES), np.int16)
    for i, w in enumerate(words):
        out[i] = np.minimum(np.bincount((w & np.uint64(PARITIES - 1)).astype(np.int64) // 32, minlength=TALLIES), 32767)
    return out


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, content, node, words, sketches, parities, tallies) of a table of (doc_id, text).

    ``content`` is a hash of the text, ``node`` one of its words (of the text
    where it has none). ``sketches``, ``parities`` and ``tallies`` are null where there are no words.
    """
    ready(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.xxhash64(F.col("text").isNull(), F.coalesce("text", F.lit(""))).alias("content"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("content", T.LongType()),
                           T.StructField("node", T.LongType()), T.StructField("words", T.LongType()),
                           T.StructField("sketches", T.ArrayType(T.LongType())), T.StructField("parities", T.ArrayType(T.LongType())),
                           T.StructField("tallies", T.ArrayType(T.ShortType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("near_dedup")
        for batch in sliced(batches):
            words, rows, n = [], [], 0
            contents = batch.column(2).to_pylist()
            for i, text in enumerate(batch.column(1).to_pylist()):
                words.append(word_hashes(text))
                rows.append(i)
                n += len(words[-1])
                if n >= CHUNK or i == batch.num_rows - 1:
                    some = [w for w in words if len(w)]
                    made = iter(sketches_of(some))
                    odd, tally = iter(parities(some).tolist()), iter(tallies(some).tolist())
                    node = [xxhash.xxh3_64_intdigest(w.tobytes()) - (1 << 63) if len(w) else contents[r]
                            for w, r in zip(words, rows, strict=True)]
                    part = batch.slice(rows[0], len(rows))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(2), pa.array(node, pa.int64()),
                         pa.array([len(w) for w in words], pa.int64()),
                         pa.array([next(made) if len(w) else None for w in words], pa.list_(pa.int64())),
                         pa.array([next(odd) if len(w) else None for w in words], pa.list_(pa.int64())),
                         pa.array([next(tally) if len(w) else None for w in words], pa.list_(pa.int16()))], schema.names)
                    words, rows, n = [], [], 0

    return rows.mapInArrow(run, schema)


def band_distance(a: list[int], b: list[int], most: int) -> int:
    """Edit distance of two sequences, or ``most`` + 1 if it is larger.

    Bit-parallel alignment in a band of 2 * most + 1 diagonals: bit i of
    column j is row j - most + i. The band's lowest diagonal
    is followed to the last row, and that row to the last column.
    """
    n = 0
    while n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    a, b = a[n:], b[n:]
    n = 0
    while n < len(a) and n < len(b) and a[-1 - n] == b[-1 - n]:
        n += 1
    a, b = a[:len(a) - n], b[:len(b) - n]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return min(len(b), most + 1)
    most_here = min(most, len(b))
    if len(b) - len(a) > most_here:
        return most + 1
    # Rows are a's, columns b's; the band holds the diagonals -k..k.
    k, rows, columns = most_here, len(a), len(b)
    width = 2 * k + 1
    full = (1 << width) - 1
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    # Column 0, seen from column 1, whose bit i is row 1 - k + i: steps down into rows from 1 on are +1.
    up, down = ((1 << (k + 1)) - 1) << k, 0
    bottom = score = min(k, rows)  # the lowest row of column 0 in the band and its value
    for j in range(1, columns + 1):
        shift = j - k - 1  # bit 0 is row j - k, which compares a[j - k - 1]
        mask = where.get(b[j - 1], 0)
        eq = (mask >> shift if shift >= 0 else mask << -shift) & full
        zero = ((((eq & up) + up) ^ up) | eq | down) & full
        plus = (down | ~(zero | up)) & full
        minus = zero & up
        if bottom < rows:
            # Down the lowest diagonal: its step is 0 where bit 2k of zero is set, else 1.
            bottom += 1
            score += not zero >> (2 * k) & 1
        else:
            bit = rows - (j - k)
            score += (plus >> bit & 1) - (minus >> bit & 1)
        up = (minus | ~(zero >> 1 | plus)) & full
        down = zero >> 1 & plus
        if bottom == rows and score - (columns - j) > most:
            return most + 1
    return min(score, most + 1)


def similar(a: list[int], b: list[int], least: float = SIMILARITY) -> bool:
    """Whether 1 - distance / longer length is ``least`` or more."""
    longer = max(len(a), len(b))
    most = int(longer * (1 - least) + 1e-9)
    if longer - min(len(a), len(b)) > most:
        return False
    return band_distance(a, b, most) <= most


def verified(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The (a, b) of ``pairs`` that are near duplicates; ``texts`` has (node, text).

    The pairs of one ``a`` follow its text in a sorted partition, so that its
    text moves once; a frequent ``a`` is dealt over several salts.
    """
    pairs = stored(pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(16))), f"{name}-pairs")
    first = (pairs.select("a", "salt").distinct().join(texts, F.col("a") == F.col("node"))
             .select("a", "salt", F.lit(None).cast("long").alias("b"), "text"))
    rest = pairs.join(texts, F.col("b") == F.col("node")).select("a", "salt", "b", "text")
    rows = first.unionByName(rest).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[int] = []
        keep_only("near_dedup")
        for batch in sliced(batches):
            out: list[tuple[int, int]] = []
            a_ids, b_ids = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for a, b, text in zip(a_ids, b_ids, batch.column(3).to_pylist(), strict=True):
                mine = word_hashes(text).tolist()
                if b is None:
                    words = mine
                elif similar(words, mine):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], schema.names)

    return stored(rows.select("a", "salt", "b", "text").mapInArrow(run, schema), f"{name}-links")


def possible(a: str, b: str, also: str = "true") -> Column:
    """Whether two texts may be similar by their lengths, parities and tallies; true for all that are.

    ``also`` is a further condition, tested before the dearest one.
    """
    longer = f"greatest({a}.words, {b}.words)"
    most = f"floor({longer} * (1 - {SIMILARITY}D) + 1e-9D)"
    flips = " + ".join(f"bit_count({a}.parities[{k}] ^ {b}.parities[{k}])" for k in range(PARITIES // 64))
    apart = f"{longer} - least({a}.words, {b}.words)"
    odd = f"bit_count(shiftrightunsigned({a}.parities[i div 2] ^ {b}.parities[i div 2], int(32 * (i % 2))) & 4294967295L)"
    # The sums over groups are the dearer test; most pairs never get there.
    bag = f"aggregate(sequence(0, {TALLIES - 1}), 0, (s, i) -> s + greatest(abs({a}.tallies[i] - {b}.tallies[i]), {odd}))"
    return F.expr(f"{apart} <= {most} AND {flips} + {apart} <= 2 * {most} AND {also} AND {bag} + {apart} <= 2 * {most}")


def allowed(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that may be similar; ``nodes`` has (id, words, parities, tallies)."""
    x, y = (nodes.select("id", "words", "parities", "tallies").alias(p) for p in "xy")
    return pairs.join(x, F.col("a") == F.col("x.id")).join(y, F.col("b") == F.col("y.id")).filter(possible("x", "y")).select("a", "b")


def best_leaders(members: DataFrame) -> DataFrame:
    """(a, b): each member ``b`` with the text that leads most of its buckets by ``rank``, if that isn't itself."""
    leaders = members.groupBy("bucket").agg(F.max(F.struct("rank", "id")).getField("id").alias("a"))
    votes = members.join(leaders, "bucket").filter("a <> id").groupBy(F.col("id").alias("b"), "a").agg(F.count("*").alias("n"))
    return votes.groupBy("b").agg(F.max(F.struct("n", "a")).getField("a").alias("a")).select("a", "b")


def drawn_pairs(rows: DataFrame, seed: int) -> DataFrame:
    """(a, b): members of open buckets with a leader drawn by ``seed``, if it is of another class."""
    place = F.xxhash64("id", F.lit(seed))
    leaders = rows.groupBy("bucket").agg(F.max(F.struct(place.alias("place"), "id", "component")).alias("top"))
    return (rows.join(leaders, "bucket").filter("component <> top.component")
            .select(F.col("top.id").alias("a"), F.col("id").alias("b")).distinct())


def _weighed(rows: DataFrame) -> DataFrame:
    """``rows`` with their bucket's largest class ``top`` and its comparisons ``work``; buckets of one class go."""
    sizes = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    stats = sizes.groupBy("bucket").agg(F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("most"))
    stats = stats.filter(F.col("all") > F.col("most.n")).select(
        "bucket", F.col("most.component").alias("top"), (F.col("all") * (F.col("all") - F.col("most.n"))).alias("work"))
    return rows.join(stats, "bucket")


def cross_pairs(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of different classes that share a bucket and may be similar.

    ``nodes`` has (id, words, parities, tallies), ``rows`` (bucket, id, component).
    """
    # Texts of different classes meet in every bucket that they share: all of these are open.
    mine = rows.groupBy("id").agg(F.collect_set("bucket").alias("buckets"))
    facts = nodes.select(F.col("id").alias("_id"), "words", "parities", "tallies").join(mine, F.col("id") == F.col("_id")).drop("id")
    sized = nodes.select(F.col("id").alias("_id"), "words")
    rows = stored(_weighed(rows.select("bucket", "id", "component")), "near-weighed")
    limit = HOT * HOT
    none = F.lit(0).cast("long")
    cool = rows.filter(F.col("work") <= limit).withColumns(
        {"parts": F.lit(1).cast("long"), "whole": F.col("bucket"), "own": none, "band": none})
    # Similar lengths are in one range or in ranges that follow each other.
    band = F.floor(F.log("words") / -math.log(SIMILARITY) * (1 - 1e-6))
    warm = rows.filter(F.col("work") > limit).join(sized, F.col("id") == F.col("_id"))
    warm = _weighed(warm.withColumn("own", band).withColumn("band", F.explode(F.array("own", F.col("own") + 1))).select(
        F.xxhash64("bucket", "band").alias("bucket"), "id", "component", F.col("bucket").alias("whole"), "own", "band"))
    warm = warm.withColumn("parts", F.ceil(F.col("work") / limit).cast("long"))
    both = stored(cool.unionByName(warm).join(facts, F.col("id") == F.col("_id")).drop("_id", "work"), "near-facts")
    x = both.filter("component <> top").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).alias("x")
    y = both.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).alias("y")
    other = ((F.col("y.component") == F.col("x.top")) | (F.col("x.component") < F.col("y.component")))
    # A pair is made in the first bucket that it shares, and there in the first range of lengths.
    first = "array_min(array_intersect(x.buckets, y.buckets)) = x.whole AND x.band = greatest(x.own, y.own)"
    near = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.part") == F.col("y.part")) & other & possible("x", "y", first)
    return x.join(y, near).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, content, node, words, component) of every row; equal components are one class."""
    with temporary(docs.sparkSession) as keep:
        plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        rows = stored(sketched(plain), "near-sketches")
        nodes = rows.filter("sketches IS NOT NULL").groupBy(F.col("node").alias("id")).agg(
            F.min("content").alias("content"), F.first("words").alias("words"), F.first("sketches").alias("sketches"),
            F.first("parities").alias("parities"), F.first("tallies").alias("tallies"))
        nodes = stored(nodes, "near-nodes")
        members = nodes.select("id", F.explode("sketches").alias("bucket"))
        # Buckets of one member say nothing more. A text ranks by how many others it meets: among
        # edited copies the one that they were made from meets most and leads.
        shared = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
        members = stored(members.join(shared, "bucket").select("bucket", "id", "n"), "near-shared")
        rank = members.groupBy(F.col("id").alias("_id")).agg(F.sum("n").alias("rank"))
        members = stored(members.join(rank, F.col("id") == F.col("_id")).select("bucket", "id", "rank"), "near-members")
        known = members.select(F.col("id").alias("_id")).distinct()
        wanted = nodes.join(known, F.col("id") == F.col("_id"), "left_semi").select(F.col("id").alias("node"), F.col("content").alias("_content"))
        content = F.xxhash64(F.col("text").isNull(), F.coalesce("text", F.lit("")))
        texts = (plain.select("text", content.alias("_c")).join(wanted, F.col("_c") == F.col("_content"))
                 .groupBy("node").agg(F.first("text").alias("text")))
        texts = stored(texts, "near-texts")
        found = connected_components(verified(allowed(best_leaders(members), nodes), texts, "near-stars"), "near-stars")
        seed, before = 0, None
        while True:
            rows_open = stored(open_members(members, found).select("bucket", "id", "component"), "near-open")
            left = rows_open.count()
            # The last step is complete by itself: a round that closes little isn't worth another.
            if not left or before is not None and left > CLOSED * before:
                break
            before, seed = left, seed + 1
            links = verified(allowed(drawn_pairs(rows_open, seed), nodes), texts, "near-drawn")
            found = merged_components(found, links, "near-drawn")
        if left:
            found = merged_components(found, verified(cross_pairs(nodes, rows_open), texts, "near-cross"), "near-all")
        return keep(labelled(rows.select("doc_id", "content", "node", "words").withColumn("id", F.col("node")), found).drop("id"))


def _class_of(rows: DataFrame) -> DataFrame:
    """Rows with ``group``: the component, or for empty texts nothing."""
    empty = F.xxhash64(F.lit(False), F.lit(""))
    null = F.xxhash64(F.lit(True), F.lit(""))
    alone = (F.col("words") == 0) & ((F.col("content") == empty) | (F.col("content") == null))
    return rows.withColumn("group", F.when(~alone, F.col("component")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (the least id of its class, see above), words and class_rows for each row of ``docs``."""
    rows = _class_of(classes(docs, id_col, text_col))
    rows = rows.withColumn("group", F.coalesce("group", F.xxhash64(F.lit("alone"), "doc_id", "content")))
    sizes = stored(rows.groupBy(F.col("group").alias("_group")).agg(
        F.min("doc_id").alias("least"), F.count("*").alias("class_rows")), "near-sizes")
    several = sizes.groupBy(F.col("least").alias("_least")).agg(F.count("*").alias("n")).filter("n > 1")
    own = -F.shiftrightunsigned("_group", 1) - 1
    named = sizes.join(several, F.col("least") == F.col("_least"), "left").select(
        "_group", "class_rows", F.when(F.col("least").isNull() | F.col("n").isNotNull(), own).otherwise(F.col("least")).alias("class_id"))
    return rows.join(named, F.col("group") == F.col("_group")).select("doc_id", "class_id", "words", "class_rows")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each class left: its least id, then the least content hash."""
    columns = docs.columns
    with temporary(docs.sparkSession) as keep:
        rows = _class_of(classes(docs, id_col, text_col)).filter("group IS NOT NULL")
        units = stored(rows.groupBy("group", "doc_id", "content").agg(F.count("*").alias("n")), "near-units")
        order = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "content")
        best = units.groupBy(F.col("group").alias("_group")).agg(F.min(order).alias("best"))
        judged = units.join(best, F.col("group") == F.col("_group"))
        won = F.col("best.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("best.content") == F.col("content"))
        marked = keep(stored(judged.filter(~won | (F.col("n") > 1)).select(F.col("doc_id").alias("_id"), F.col("content").alias("_was"), won.alias("_won")), "near-marked"))
    content = F.xxhash64(F.col(text_col).isNull(), F.coalesce(F.col(text_col), F.lit("")))
    joined = docs.withColumn("_content", content).join(
        marked, F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (F.col("_content") == F.col("_was")), "left")
    single = joined.filter("_won IS NULL").select(*columns)
    if marked.filter("_won").isEmpty():  # else the join would be planned twice for nothing
        return single
    # Identical rows of a winner: one of them.
    repeated = joined.filter("_won").dropDuplicates(["_id", "_was"]).select(*columns)
    return single.unionByName(repeated)
