"""Phrase collocations from suffix subtrees that are built group by group.

Texts are cut into pieces and words. The suffixes of the pieces, by words and
truncated, form a tree for each language; a phrase's frequency is the number of
leaves below its node. The tree never exists as a whole:

1. ``word_counts`` counts the words: prefixes of one word.
2. ``gather`` collects, for each first word of a chunk of text, its distinct
   truncated suffixes with counts, in order, as one row. A word below the least
   frequency ends a suffix. A bitmap of fixed size, one bit for each frequent
   word's hash, tells tasks which these are; a wrong bit only lets a suffix
   live on.
3. ``partition`` is the vertical partitioning: prefixes with more suffixes than
   the budget allows are extended by a word until they fit; a prefix that is as
   long as a suffix is a leaf and becomes a sum. The others are packed into
   groups of about the budget.
4. ``subtrees`` sorts each group's suffixes on its own, which lays the subtree
   out as runs, and reads every node's count from its leaves' totals.

Steps 2 to 4 run twice: down to two words, and from the frequent pairs, which
a second bitmap tells, down to four.

Scores, cuts and what longer phrases cover are joins and aggregates over the
frequent phrases only.

Defined cases: a null or empty text has no words; a null language is ``und``
and one with rows of that name; ids don't matter and repeated rows count each;
texts are read whole and a chunk of a long one ends at the end of a piece, so
that memory grows with a text and not with the table; an empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transitlens.llm.common import ready, stored

#: Most words of a phrase.
DEPTH = 4
#: Fixed values of the scoring.
SCORE_SCALE, COVERED_PERCENT = 2_000_000, 80
#: Suffixes that a group should hold, and the share of it that one prefix may have.
BUDGET, PREFIX_SHARE = 1_000_000, 1
#: Words of a chunk, and different words that a task counts before it hands them on.
CHUNK, COUNTED = 1_500_000, 200_000
#: Places of a bitmap (8 MB).
BITS = 1 << 26
BITMAP_ROW, PAIR = 32_768, 1_000_003

#: Everything that ends a piece becomes a full stop and tabs become blanks.
CUTS = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b"......... ")
STOP = b"."
ROWS = "lang string, prefix string, depth int, tails binary, counts binary, entries long"
NAMES = ["lang", "prefix", "depth", "tails", "counts", "entries"]


def blocks(text: str | None, size: int = 4 << 20) -> Iterator[bytes]:
    """A text in lower case with normal separators, in parts of about ``size`` bytes that end where a piece ends."""
    data = (text or "").encode().lower().translate(CUTS)
    start = 0
    while len(data) - start > size:
        end = data.rfind(STOP, start, start + size)
        end = end if end >= 0 else data.find(STOP, start + size)
        if end < 0:
            break
        yield data[start:end + 1]
        start = end + 1
    yield data[start:] if start else data


def words_of(block: bytes) -> list[bytes]:
    """Words and, at the end of pieces, full stops."""
    return block.replace(STOP, b" . ").split()


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                for block in blocks(text):
                    yield lang, block


def word_counts(texts: DataFrame, least: int) -> DataFrame:
    """(lang, word, f) of words with ``least`` occurrences, and with a null word the number of all in the language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                found.pop(STOP, None)
                words = pa.array([*found, None], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), words,
                                                  pa.array([*found.values(), found.total()], pa.int64())], ["lang", "word", "f"])
            counts.clear()

        for lang, block in _by_lang(batches):
            counts.setdefault(lang, Counter()).update(words_of(block))
            if sum(map(len, counts.values())) > COUNTED:
                yield from rows()
        yield from rows()

    return (texts.mapInArrow(run, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))
            .filter(F.col("word").isNull() | (F.col("f") >= least)))


def _hash(word: str):
    return F.crc32(F.concat("lang", F.lit(" "), F.expr(word)).cast("binary"))


def bitmap(places: DataFrame) -> np.ndarray:
    """One bit for each hash in ``place``, ``BITS`` in all whatever their number."""
    place = F.pmod("place", F.lit(BITS)) + 1
    rows = (places.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("row"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect())
    out = np.zeros((BITS // BITMAP_ROW, BITMAP_ROW // 8), np.uint8)
    for r in rows:
        out[r["row"] - 1] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def word_bits(words: DataFrame) -> np.ndarray:
    return bitmap(words.filter("word IS NOT NULL").select(_hash("word").alias("place")))


def pair_bits(pairs: DataFrame) -> np.ndarray:
    return bitmap(pairs.select((_hash("substring_index(phrase, ' ', 1)") * PAIR + _hash("substring_index(phrase, ' ', -1)")).alias("place")))


def _set(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    places = places % BITS
    return (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def runs(columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of the rows by all columns, and for each number of leading columns where new values start.

    Values are whole numbers below 2 ** 31.
    """
    keys = [a << 32 | b for a, b in zip(columns[::2], [*columns[1::2], *[np.zeros_like(columns[0])] * (len(columns) % 2)], strict=True)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    starts = []
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
        starts.append(np.flatnonzero(new))
    return order, starts


def _offsets(starts: np.ndarray, end: int) -> pa.Array:
    return pa.array(np.append(starts, end), pa.int32())


def chunk_leaves(tokens: pa.ChunkedArray, lang: str, words: np.ndarray, pairs: np.ndarray | None) -> pa.RecordBatch | None:
    """The distinct suffixes of a chunk, one row for each first word.

    Without ``pairs`` those of two frequent words; with them those of three or
    more words in which every pair of neighbours is frequent.
    """
    coded = tokens.combine_chunks().dictionary_encode()
    names = coded.dictionary.to_pylist()
    seed = zlib.crc32(lang.encode() + b" ")
    # Word 0 is the empty one, which follows where a suffix ends.
    hashes = np.fromiter((zlib.crc32(w, seed) for w in [b"", *names]), np.int64, len(names) + 1)
    frequent = _set(words, hashes) & np.array([False, *(w != STOP for w in names)])
    ids = np.append(coded.indices.to_numpy().astype(np.int64) + 1, np.zeros(DEPTH, np.int64))
    vocabulary = pa.concat_arrays([pa.array([b""], pa.binary()), coded.dictionary])
    alive = frequent[ids]
    linked = alive[:-1] & alive[1:]
    depth, least = 2, 1
    if pairs is not None:
        depth, least = DEPTH, 2
        at = np.flatnonzero(linked)
        linked[at] = _set(pairs, hashes[ids[at]] * PAIR + hashes[ids[at + 1]])
    starts = np.flatnonzero(linked[:-1] & linked[1:] if least == 2 else linked)
    if not len(starts):
        return None
    columns, live = [ids[starts]], np.ones(len(starts), bool)
    for k in range(1, depth):
        live &= linked[starts + k - 1]
        columns.append(np.where(live, ids[starts + k], 0))
    order, begins = runs(columns)
    leaf = begins[-1]
    counts = np.diff(np.append(leaf, len(order))).astype(np.int32)
    columns = [c[order[leaf]] for c in columns]
    first = np.flatnonzero(np.diff(columns[0], prepend=-1))
    tails = pc.binary_join_element_wise(*[vocabulary.take(pa.array(c)) for c in columns[1:]], b" ")
    bounds = _offsets(first, len(leaf))
    n = len(first)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), vocabulary.take(pa.array(columns[0][first])).cast(pa.string()), pa.array([1] * n, pa.int32()),
         pc.binary_join(pa.ListArray.from_arrays(bounds, tails), b" "),
         pa.Array.from_buffers(pa.binary(), n, [None, _offsets(4 * first, 4 * len(leaf)).buffers()[1], pa.py_buffer(counts)]),
         pa.array(np.diff(np.append(first, len(leaf))), pa.int64())], NAMES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    lang, prefix, depth, tails, counts, entries = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(prefix, pa.binary()).cast(pa.string()), pa.array(depth, pa.int32()),
         pa.array(tails, pa.binary()), pa.array(counts, pa.binary()), pa.array(entries, pa.int64())], NAMES)


def _leaves(chunks: dict[str, list[pa.Array]], words: np.ndarray, pairs: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The rows of all open chunks, which are emptied."""
    for lang, tokens in chunks.items():
        found = chunk_leaves(pa.chunked_array(tokens), lang, words, pairs)
        if found is not None:
            yield found
    chunks.clear()


def gather(texts: DataFrame, words: np.ndarray, pairs: np.ndarray | None) -> DataFrame:
    """Rows of (lang, prefix, depth, tails, counts, entries): a chunk's suffixes that start with a prefix.

    ``tails`` has what follows the prefix in each suffix, empty words where it
    ends, all with a blank between.
    """
    context = texts.sparkSession.sparkContext
    shared_words, shared_pairs = context.broadcast(words), context.broadcast(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_chunks: dict[str, list[pa.Array]] = {}
        size = 0
        for lang, block in _by_lang(batches):
            words_here = pa.array([*words_of(block), STOP], pa.binary())
            open_chunks.setdefault(lang, []).append(words_here)
            size += len(words_here)
            if size > CHUNK:
                yield from _leaves(open_chunks, shared_words.value, shared_pairs.value)
                size = 0
        yield from _leaves(open_chunks, shared_words.value, shared_pairs.value)

    return texts.mapInArrow(run, ROWS)


def extended(rows: DataFrame, length: int) -> DataFrame:
    """Every row dealt out by the next word of its suffixes, which have ``length`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words = np.array(r["tails"].split(b" "), object).reshape(r["entries"], length - r["depth"])
                counts = np.frombuffer(r["counts"], np.int32)
                first = np.flatnonzero(np.append(True, words[1:, 0] != words[:-1, 0]))
                yield _batch([(r["lang"], r["prefix"].encode() + b" " + words[a, 0], r["depth"] + 1,
                               b" ".join(words[a:b, 1:].ravel()), counts[a:b].tobytes(), b - a)
                              for a, b in zip(first.tolist(), [*first[1:].tolist(), len(words)], strict=True)])

    return rows.mapInArrow(run, ROWS)


def partition(rows: DataFrame, length: int, budget: int = BUDGET) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose prefixes fit the budget, with ``group``; leaves of those that never do, or None)."""
    limit = max(1, budget // PREFIX_SHARE)
    groups = max(1, -(-2 * (rows.agg(F.sum("entries")).first()[0] or 0) // budget))
    fitting, leaves = None, None
    for depth in range(1, length + 1):
        heavy = stored(rows.groupBy("lang", "prefix").agg(F.sum("entries").alias("load")).filter(F.col("load") > limit)
                       .select("lang", "prefix"), "phrase-heavy")
        light = rows if heavy.isEmpty() else rows.join(heavy, ["lang", "prefix"], "left_anti").select(rows.columns)
        fitting = light if fitting is None else fitting.unionByName(light)
        if light is rows:
            break
        rows = rows.join(heavy, ["lang", "prefix"], "left_semi").select(rows.columns)
        if depth == length:
            leaves = rows
        else:
            rows = stored(extended(rows, length), "phrase-rows")
    return fitting.withColumn("group", F.pmod(F.xxhash64("lang", "prefix"), F.lit(groups))), leaves


def _words(column: pa.Array) -> pa.Array:
    return pc.split_pattern(column.cast(pa.string()), " ").flatten()


def group_nodes(table: pa.Table, least: int, length: int) -> tuple[list, list, list, list]:
    """(lang, phrase, words, leaves) of the nodes of a group's subtree, from two words on in one that is two deep, else three.

    A node above a prefix has only the leaves of this group and is given
    whatever their number, the others from ``least`` leaves on.
    """
    pieces, shapes, langs, counts = [], [], [], []
    for d in range(1, length + 1):
        rows = table.filter(pc.equal(table["depth"], d)).combine_chunks()
        if not rows.num_rows:
            continue
        lang, prefix, _, tails, leaves, entries = (rows.column(c).combine_chunks() if rows.column(c).num_chunks != 1
                                                   else rows.column(c).chunk(0) for c in NAMES)
        entries = entries.to_numpy()
        pieces.append(_words(prefix))
        if d < length:
            pieces.append(_words(tails))
        shapes.append((d, entries))
        langs.append((lang, entries))
        counts += leaves.to_pylist()
    coded = pa.concat_arrays(pieces).dictionary_encode()
    names, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64) + 1
    ids[ids == pc.index(names, "").as_py() + 1] = 0
    lang_coded = pa.concat_arrays([a for a, _ in langs]).dictionary_encode()
    lang_ids = np.repeat(lang_coded.indices.to_numpy().astype(np.int64), np.concatenate([e for _, e in langs]))
    parts, depths, at = [], [], 0
    for d, entries in shapes:
        head, at = ids[at:at + len(entries) * d].reshape(-1, d), at + len(entries) * d
        total = int(entries.sum())
        tail, at = ids[at:at + total * (length - d)].reshape(total, length - d), at + total * (length - d)
        parts.append(np.concatenate([np.repeat(head, entries, axis=0), tail], axis=1))
        depths.append(np.full(total, d))
    words, depth, leaves = np.concatenate(parts), np.concatenate(depths), np.frombuffer(b"".join(counts), np.int32).astype(np.int64)
    order, starts = runs([lang_ids, *words.T])
    lang_ids, words, depth, leaves = lang_ids[order], words[order], depth[order], leaves[order]
    names, lang_names = np.array(names.to_pylist(), object), lang_coded.dictionary.to_pylist()
    out: tuple[list, list, list, list] = ([], [], [], [])
    for k in range(min(3, length), length + 1):
        begin = starts[k]
        total = np.add.reduceat(leaves, begin)
        kept = (words[begin, k - 1] > 0) & ((total >= least) | (depth[begin] > k))
        begin, total = begin[kept], total[kept]
        out[0].extend(lang_names[i] for i in lang_ids[begin])
        out[1].extend(" ".join(w) for w in names[words[begin, :k] - 1])
        out[2].extend([k] * len(begin))
        out[3].extend(total.tolist())
    return out


def subtrees(rows: DataFrame, least: int, length: int) -> DataFrame:
    """(lang, phrase, words, f) of each group's nodes."""
    def run(table: pa.Table) -> pa.Table:
        lang, phrase, words, f = group_nodes(table, least, length)
        return pa.Table.from_arrays([pa.array(lang, pa.string()), pa.array(phrase, pa.string()),
                                     pa.array(words, pa.int32()), pa.array(f, pa.int64())], ["lang", "phrase", "words", "f"])

    return rows.groupBy("group").applyInArrow(run, "lang string, phrase string, words int, f long")


def leaf_nodes(rows: DataFrame, length: int) -> DataFrame:
    """Rows whose prefixes are whole suffixes as (lang, phrase, words, f): the leaf itself and the nodes above it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                words, n = r["prefix"].split(" "), int(np.frombuffer(r["counts"], np.int32).sum())
                out += [(r["lang"], " ".join(words[:k]), k, n) for k in range(min(3, length), length + 1) if words[k - 1]]
            lang, phrase, k, n = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(phrase), pa.array(k, pa.int32()), pa.array(n, pa.int64())],
                                             ["lang", "phrase", "words", "f"])

    return rows.mapInArrow(run, "lang string, phrase string, words int, f long")


def tree(texts: DataFrame, words: np.ndarray, pairs: np.ndarray | None, least: int, budget: int) -> DataFrame:
    """(lang, phrase, words, f) of the frequent phrases of two words, or with ``pairs`` of three and four."""
    length = 2 if pairs is None else DEPTH
    fitting, leaves = partition(stored(gather(texts, words, pairs), "phrase-rows", compression="zstd"), length, budget)
    nodes = subtrees(fitting, least, length)
    if leaves is not None:
        nodes = nodes.unionByName(leaf_nodes(leaves, length))
    return stored(nodes.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).filter(F.col("f") >= least), "phrases")


def phrase_counts(texts: DataFrame, least: int, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) of all phrases of one to four words from ``least`` on, (lang, n)) of texts (lang, text)."""
    words = stored(word_counts(texts, least), "phrase-words")
    bits = word_bits(words)
    pairs = tree(texts, bits, None, least, budget)
    longer = tree(texts, bits, pair_bits(pairs), least, budget)
    single = words.filter("word IS NOT NULL").select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "f")
    return single.unionByName(pairs).unionByName(longer), words.filter("word IS NULL").select("lang", F.col("f").alias("n"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, lang_col: str = "lang", text_col: str = "text",
                 budget: int = BUDGET) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase of two to four words with a >= ``least`` occurrences is cut in two
    where floor(2000000 * a / (l + r)) is lowest, l and r being the parts'
    frequencies. Phrases that a longer one covers (in 80 of 100 occurrences or
    more) are left out.
    """
    ready(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    phrases, totals = phrase_counts(texts, least, budget)
    found = phrases.filter("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    part = lambda first, count: F.concat_ws(" ", F.slice("w", first, count))
    cuts = (found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"),
                    part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest")))
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    # Whole-number division of decimals: products pass 64 bits.
    score = F.expr(f"(CAST({SCORE_SCALE} AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    scored = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")))

    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.concat_ws(" ", F.slice("w", i, n))))))
    longer = (found.filter("words >= 3").select("lang", inner.alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100) * wide("longer") < F.lit(COVERED_PERCENT) * wide("a")))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score",
                       F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("salt"))
    best = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
          FROM spots, (VALUES (1), (2), (3), (4)) AS ks(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
found AS (SELECT lang, k AS words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cuts AS (SELECT lang, phrase, a, words, w, unnest(range(1, words)) AS c FROM found),
scored AS (SELECT c.lang, c.phrase, c.a, c.c, l.f AS l, r.f AS r,
             CAST((CAST(2000000 AS HUGEINT) * c.a) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
           FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.c], ' ')
           JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.c + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
longer AS (SELECT lang, phrase, max(a) AS top FROM (
             SELECT found.lang, found.a, array_to_string(found.w[i:i + n - 1], ' ') AS phrase
             FROM found, (VALUES (2), (3)) AS ns(n), (VALUES (1), (2), (3)) AS spots(i)
             WHERE n < found.words AND i + n - 1 <= found.words) GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase)
         WHERE top IS NULL OR 100 * CAST(top AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
