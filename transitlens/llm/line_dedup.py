"""Fuzzy line deduplication over all documents, with DataFrame functions only.

Lines are normalised to their lower-case words of letters and digits. Equal
normalised lines are one node. A line's SimHash has, in each of 64 places, the
majority of the hash bits of all its words. Lines whose SimHashes differ in ``DISTANCE``
places or fewer agree in at least ``BLOCKS - DISTANCE`` of ``BLOCKS`` blocks,
so each SimHash is filed under every choice of that many blocks, and compared with
the least one of each bucket. Lines of SimHashes that are close or equal are then compared
with one line of the other SimHash: by their lengths, then by edit similarity, in words, of ``SIMILARITY`` or more.

SimHashes so close are rare for lines of ordinary length, so all lines meet once
more, in buckets that no similar pair escapes. Two lines are similar if k = (1 -
``SIMILARITY``) * the longer length edits or fewer make them equal, and an edit breaks
three of a line's runs of three words at most. At least one run is left if the longer
line has six words. So if the runs of all lines are put in one order, the first one that
two similar lines have in common is among the first 3 * k + 1 of both. A partner that is d
words longer allows the edits of its length, but d of them are new words between two old
ones, which break two runs; so the most of 3 * k - d counts. Lines of four and five words
meet by pairs of words, of which an edit breaks two. The order takes runs that few lines
have first: those that no other line has, by counting where all runs meet once. A line
with more of these than 3 * k is similar to no other and goes, which most lines do; the
others are filed under what is left of their first 3 * k + 1 runs. Members are compared with
a leader, then all pairs that are still in different groups: by their lengths, by
``PARITIES`` * 64 parities of their words' counts and by the counts of words in
``PARITIES`` * 2 groups of these (lines that say few words many times have next to no
odd ones), then by edit similarity. Half of (words that only one of two lines has, and
the difference of the lengths) is a distance that no edits are below; in a group these
words are no fewer than the parities that differ there and than the difference of the
counts. Neither step loses a similar pair. Pairs of lines that share several buckets are
left out of a bucket if one of the two buckets before it is the same for both lines: the
pair is made there, or in a bucket further in front.

What moves by bucket moves in up to ``PASSES`` parts of the buckets (one for each
``PART`` different lines), one after the other, and
a part's shuffle files go when its result is written. Lines themselves move once, to
find the different ones, whose words' hashes are stored; those of candidates are read from
there, where a bitmap of fixed size tells which lines may be these. What a step has stored
goes when no later step reads it.

Of each connected group of lines one occurrence stays, that of the least id
and the earliest place; all others are taken out of their documents.

No group is written out as pairs: members of a bucket are compared with one
leader first, those outside a crowded bucket's largest group with some of its lines
(one leader may be like none of the others), and of those that are then still in
different groups only pairs that lengths and parities allow are written.
Equal lines become one row of words' hashes before anything else is made of them. Words are counted into the SimHash's places by
sums of four places each, 16 bits a place, for lines under ``PACKED`` words,
and of one place each for longer ones, of which there are few.

Normalised lines and texts are known by 64-bit hashes. For the edit similarity a
word is one of 1.1 million characters; what passes is compared with a second such
numbering, so that words that share a character don't make a line similar.

Defined cases: lines without a letter or digit always stay; a null text stays
null; identical rows (same id and text) count as occurrences one after the
other, so that the first keeps its lines and the others lose theirs; null ids
come last; a document that loses all its lines has an empty text and stays; an
empty table gives an empty result. Columns other than the text are unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlens.llm.common import connected_components, labelled, merged_components, stored, temporary

DISTANCE = 3
BLOCKS = 5
SIMILARITY = 0.8
PACKED = 16_383
PARITIES = 8
#: The most parts of the buckets that are worked off one after the other, and the different lines that make another one worthwhile.
PASSES, PART = 4, 250_000
#: Bytes of different words' hashes that a file of lines may name by short numbers.
DICTIONARY = 8 << 20
#: Lines of one component in a bucket that make it crowded, and how many of them its other lines are compared with first.
CROWD, LEADERS = 32, 16
#: Places of the bitmap that tells lines of candidates, 64 in a row: 2 ** 19 rows are sent to the tasks at most.
PLACES = 1 << 25
#: Where the blocks of a SimHash begin and end.
EDGES = [64 * n // BLOCKS for n in range(BLOCKS + 1)]


def line_words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), r"[^\p{L}\p{N}]+"), "")


def _has_words(line: Column) -> Column:
    return line.rlike(r"[\p{L}\p{N}]")


def content_of(text: Column) -> Column:
    return F.xxhash64(text)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, content, pos, words, id, n) of the lines with words of a table of (doc_id, text)."""
    lines = docs.filter("text IS NOT NULL").select(
        "doc_id", content_of(F.col("text")).alias("content"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    words = lines.filter(_has_words(F.col("line"))).select("doc_id", "content", "pos", line_words(F.col("line")).alias("words"))
    return words.select("doc_id", "content", "pos", "words", F.xxhash64("words").alias("id"), F.size("words").alias("n"))


def _packed(n: str) -> Column:
    """The SimHash from sums s0 .. s15, of which s_b holds the counts of the places b, b + 16, b + 32 and b + 48.

    Twice a count is above ``n`` if adding 0x3FFF - n sets the bit above these 14. All four stay below
    2 ** 15, so that nothing carries over.
    """
    ones = 0x0001000100010001
    bits = [f"shiftleft(shiftrightunsigned(shiftleft(s{b}, 1) + (16383 - {n}) * {ones}L, 14) & {ones}L, {b})" for b in range(16)]
    return F.expr(" | ".join(bits))


def _words(docs: DataFrame) -> DataFrame:
    """(id, raw, hashes) of every different line with words: a hash of one line as it is in the documents, and those of its words, in order."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).filter(_has_words(F.col("line")))
    split = lines.select(F.xxhash64("line").alias("raw"), line_words(F.col("line")).alias("words"))
    hashed = split.select(F.xxhash64("words").alias("id"), "raw", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    return hashed.groupBy("id").agg(F.first("raw").alias("raw"), F.first("hashes").alias("hashes"))


def _sums(words: DataFrame) -> DataFrame:
    """(id, raw, n, simhash, p0 .., t0 ..) of what ``_words`` has: number of words, SimHash, parities of the words' counts, counts.

    A group of words has one half of a parity column, and 16 bits of a column t0 .. for its count.
    """
    parity = [F.expr(f"bit_xor(if((shiftrightunsigned(h, 6) & {PARITIES - 1}) = {k}, shiftleft(1L, CAST(h & 63 AS INT)), 0L))").alias(f"p{k}")
              for k in range(PARITIES)]

    # Shifts and masks only, so that the generated method stays small enough to be compiled.
    by_16 = [F.expr(f"sum(if((shiftrightunsigned(h, 7) & {PARITIES // 2 - 1}) = {k}, shiftleft(1L, CAST(shiftrightunsigned(h, 1) & 48 AS INT)), 0L))").alias(f"t{k}")
             for k in range(PARITIES // 2)]
    by_32 = [F.expr(f"sum(if((shiftrightunsigned(h, 6) & {PARITIES - 1}) = {k}, shiftleft(1L, CAST(h & 32 AS INT)), 0L))").alias(f"t{k}")
             for k in range(PARITIES)]

    def counted(some: DataFrame, mask: int, sums: int, groups: list[Column]) -> DataFrame:
        return some.select("id", "raw", F.explode("hashes").alias("h")).groupBy("id", "raw").agg(F.count("*").cast("int").alias("n"), *parity, *groups, *[
            F.expr(f"sum(shiftrightunsigned(h, {b}) & {mask}L)").alias(f"s{b}") for b in range(sums)])

    out = ["id", "raw", "n", *[f"p{k}" for k in range(PARITIES)]]
    counts = [f"t{k}" for k in range(PARITIES // 2)]
    few = F.size("hashes") < PACKED
    packed = counted(words.filter(few), 0x0001000100010001, 16, by_16)
    plain = counted(words.filter(~few), 1, 64, by_32)
    # Counts that are cut at 15 bits differ no more than whole ones.
    cut = lambda k, half: f"shiftleft(least(shiftrightunsigned(t{k}, {32 * half}) & 4294967295L, 32767L), {16 * (2 * (k % 2) + half)})"
    halves = [F.expr(" | ".join(cut(k, half) for k in (2 * j, 2 * j + 1) for half in (0, 1))).alias(f"t{j}") for j in range(PARITIES // 2)]
    majority = F.expr(" | ".join(f"shiftleft(CAST(s{b} * 2 > n AS BIGINT), {b})" for b in range(64)))
    return packed.select(*out, *counts, _packed("n").alias("simhash")).unionByName(plain.select(*out, *halves, majority.alias("simhash")))


def _signed(docs: DataFrame) -> DataFrame:
    """(id, raw, n, simhash, p0 .., t0 .., hashes) of the different lines: what ``_sums`` and ``_words`` have."""
    words = _words(docs)
    return _sums(words).join(words.select(F.col("id").alias("_id"), "hashes"), F.col("id") == F.col("_id")).drop("_id")


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, content, pos, id, n, simhash) of every line with words of every row."""
    hashes = _sums(_words(docs)).select(F.col("id").alias("_id"), "simhash")
    return _lines(docs).join(hashes, F.col("id") == F.col("_id")).select("doc_id", "content", "pos", "id", "n", "simhash")


def _buckets(simhash: Column) -> Column:
    """An array of the buckets that a SimHash is filed under: the blocks of one choice and the choice's number."""
    block = [F.shiftrightunsigned(F.shiftleft(simhash, 64 - EDGES[k + 1]), 64 - EDGES[k + 1] + EDGES[k]) for k in range(BLOCKS)]
    out = []
    for number, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - DISTANCE)):
        key = F.lit(number).cast("long")
        for k in chosen:
            key = F.shiftleft(key, EDGES[k + 1] - EDGES[k]).bitwiseOR(block[k])
        out.append(key)
    return F.array(*out)


def _close(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def _in_part(rows: DataFrame, k: int, parts: int = PASSES) -> DataFrame:
    """The rows of the ``k``-th of so many parts of the buckets."""
    if parts == 1:
        return rows
    # A number would be written into the generated code; an array isn't, so that all parts share one compiled class.
    return rows.filter(F.array_contains(F.array(F.lit(k).cast("long")), F.pmod(F.xxhash64("bucket", F.lit(PASSES)), F.lit(parts))))


def _in_passes(part: Callable[[int], DataFrame], name: str, parts: int) -> DataFrame:
    """What ``part(k)`` has for every part k of the buckets; the shuffle files of one go before the next."""
    return reduce(DataFrame.unionByName, [stored(part(k), name) for k in range(parts)])


def _widest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(F.max("n").alias("n"))


def _led_values(values: DataFrame, k: int, parts: int = PASSES) -> DataFrame:
    """(leader, simhash): SimHashes near the least one of a bucket of the ``k``-th part."""
    filed = _in_part(values.select("simhash", F.explode(_buckets(F.col("simhash"))).alias("bucket")), k, parts)
    led = filed.withColumn("leader", F.min("simhash").over(Window.partitionBy("bucket")))
    return led.filter((F.col("simhash") != F.col("leader")) & _close("simhash", "leader")).select("leader", "simhash")


def _coded(hashes: Column, seed: int) -> Column:
    """A text with one character for each word, for the edit distance in words."""
    def character(h: Column) -> Column:
        number = F.pmod(F.xxhash64(h, F.lit(seed)), F.lit(0x10F7FF)) + 1
        return F.lpad(F.hex(number + F.when(number >= 0xD800, 0x800).otherwise(0)), 8, "0")  # no surrogates

    return F.decode(F.unhex(F.array_join(F.transform(hashes, character), "")), "UTF-32")


def _likely(rows: DataFrame, key: str, wanted: DataFrame, by: str) -> DataFrame:
    """The rows whose ``key`` is a ``by`` of ``wanted``, and next to none of the others; nothing of ``rows`` is moved."""
    place = lambda h: F.pmod(h, F.lit(PLACES))
    bits = wanted.select(place(F.col(by)).alias("place")).groupBy(F.shiftright("place", 6).alias("_row")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("_bits"))
    placed = rows.withColumn("_place", place(F.col(key)))
    return placed.join(F.broadcast(bits), F.shiftright("_place", 6) == F.col("_row")).filter(
        "shiftrightunsigned(_bits, CAST(_place & 63 AS INT)) & 1L = 1L").select(*rows.columns)


def _lines_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, line) of the lines of ``wanted`` (id, _raw); of the other lines next to none is moved."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).withColumn("_hash", F.xxhash64("line"))
    return _likely(lines, "_hash", wanted, "_raw").join(wanted, F.col("_hash") == F.col("_raw")).groupBy("id").agg(F.first("line").alias("line"))


def _verified(pairs: DataFrame, words: DataFrame, name: str) -> DataFrame:
    """The (a, b) of ``pairs`` (a, b, n the longer length) with similar words."""
    pairs = stored(pairs, f"{name}-pairs")
    ids = stored(pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id"))).distinct(), f"{name}-wanted")
    mine = _likely(words.select("id", "hashes"), "id", ids, "_id").join(ids, F.col("id") == F.col("_id"), "left_semi")
    coded = stored(mine.select("id", *[_coded(F.col("hashes"), k).alias(f"coded{k}") for k in range(2)]), f"{name}-coded")
    a, b = (coded.select(F.col("id").alias(x), *[F.col(f"coded{k}").alias(f"{x}{k}") for k in range(2)]) for x in "ab")
    # -1 says that there are more edits.
    similar = " AND ".join(f"levenshtein(a{k}, b{k}, {_most('n')}) >= 0" for k in range(2))
    return stored(pairs.join(a, "a").join(b, "b").filter(similar).select("a", "b"), name)


def _stars(nodes: DataFrame, values: DataFrame, led: DataFrame) -> DataFrame:
    """(a, b, n): lines with the line that leads their SimHash or one near it, where lengths allow them to be similar.

    ``values``: (simhash, lines, first) of every SimHash, with its number of lines and the least of them.
    """
    first = values.select(F.col("simhash").alias("leader"), F.col("first").alias("a"))
    # Equal SimHashes of different lines have a leader of their own.
    rows = led.join(first, "leader").select("simhash", "a").unionByName(values.filter("lines > 1").select("simhash", F.col("first").alias("a")))
    met = rows.join(nodes.select("simhash", F.col("id").alias("b"), F.col("n").alias("b_n")), "simhash").filter("a <> b")
    both = met.join(nodes.select(F.col("id").alias("a"), F.col("n").alias("a_n")), "a")
    return _widest(both.filter(F.least("a_n", "b_n") >= SIMILARITY * F.greatest("a_n", "b_n")).select("a", "b", F.greatest("a_n", "b_n").alias("n")))


def _most(n: str) -> str:
    """The edits that leave a line of ``n`` words similar."""
    return f"CAST(floor(({n}) * (1 - {SIMILARITY}D) + 1e-9D) AS INT)"


def _counts() -> list[str]:
    return [*[f"p{k}" for k in range(PARITIES)], *[f"t{k}" for k in range(PARITIES // 2)]]


def _filed(words: DataFrame, k: int, parts: int) -> DataFrame:
    """(bucket, id, n) of the lines under all their runs of three words; of two words, or both, if they have four or five.

    The first word of a run tells which part has it, so that other parts needn't hash the run.
    """
    placed = words.select("id", F.size("hashes").alias("n"), "hashes", F.posexplode("hashes").alias("at", "word"))
    if parts > 1:
        placed = placed.filter(F.array_contains(F.array(F.lit(k).cast("long")), F.pmod("word", F.lit(parts))))
    word = lambda j: F.get("hashes", F.col("at") + j)
    threes = placed.filter("n >= 5 AND at < n - 2").select(F.xxhash64("word", word(1), word(2)).alias("bucket"), "id", "n")
    twos = placed.filter("n IN (4, 5) AND at < n - 1").select(F.xxhash64("word", word(1)).alias("bucket"), "id", "n")
    return threes.unionByName(twos)


def _shared(words: DataFrame, k: int, parts: int = PASSES) -> DataFrame:
    """(bucket, id, n, lines) of the lines under their runs of words of one of ``parts``, where another line is as well.

    ``lines``: how often the run is there. Two lines alone have to be of lengths that allow them to be similar.
    """
    bucket = Window.partitionBy("bucket")
    several = _filed(words, k, parts).withColumns({
        "low": F.min("id").over(bucket), "high": F.max("id").over(bucket), "lines": F.count("*").over(bucket),
        "short": F.min("n").over(bucket), "long": F.max("n").over(bucket)})
    return several.filter(f"low <> high AND (lines > 2 OR long - short <= {_most('long')})").select("bucket", "id", "n", "lines")


def _narrowed(shared: DataFrame) -> DataFrame:
    """(bucket, id, lines): each line under the runs that it needs, rare ones first; ``shared`` has all parts of the buckets.

    What a line has in no other line stands before all others in the order of ``lines``; so a line that has
    more such runs than the edits of a similar pair break goes.
    """
    # No line of fewer than four words is similar to one that isn't equal; one of four words has partners of five at most.
    most = F.expr(f"greatest({', '.join(f'3 * {_most(f'n + {d}')} - {d}' for d in range(3))}) + 1")
    line = Window.partitionBy("id")
    needed = F.when(F.col("n") >= 6, most - (F.col("n") - 2 - F.col("common"))).otherwise(F.col("common"))
    some = shared.withColumn("common", F.count("*").over(line)).withColumn("needed", needed).filter("needed > 0")
    ranked = some.withColumn("at", F.row_number().over(line.orderBy("lines", "bucket"))).filter("at <= needed")
    return ranked.select("bucket", "id", "lines").distinct()


def _possible(a: str, b: str) -> Column:
    """Whether two lines may be similar by their lengths, parities and counts; true for all that are."""
    flips = " + ".join(f"bit_count({a}p{k} ^ {b}p{k})" for k in range(PARITIES))
    longer = f"greatest({a}n, {b}n)"
    apart = f"{longer} - least({a}n, {b}n)"
    # What needs no shift or mask has none, as the join's method has to stay small enough to be compiled.
    lane = lambda x, g: (f"({x}t{g // 4} & 65535L)", *[f"(shiftrightunsigned({x}t{g // 4}, {16 * j}) & 65535L)" for j in (1, 2)],
                         f"shiftrightunsigned({x}t{g // 4}, 48)")[g % 4]
    odd = lambda g: (f"bit_count(({a}p{g // 2} ^ {b}p{g // 2}) & 4294967295L)",
                     f"bit_count(shiftrightunsigned({a}p{g // 2} ^ {b}p{g // 2}, 32))")[g % 2]
    bag = " + ".join(f"greatest(abs({lane(a, g)} - {lane(b, g)}), {odd(g)})" for g in range(2 * PARITIES))
    return F.expr(f"{apart} <= {_most(longer)} AND {flips} + {apart} <= 2 * {_most(longer)} AND {bag} + {apart} <= 2 * {_most(longer)}")


def _facts(signed: DataFrame, p: str = "") -> DataFrame:
    """What ``_possible`` reads, declared as never null: a method with checks for nulls is too long to be compiled."""
    return signed.select(F.col("id").alias(f"{p}id"), *[F.coalesce(c, F.lit(0)).alias(f"{p}{c}") for c in ("n", *_counts())])


def _met(shared: DataFrame, components: DataFrame, k: int, parts: int = PASSES) -> DataFrame:
    """(a, b): members of the ``k``-th part with their bucket's leader, where they are in different components."""
    rows = labelled(_in_part(shared, k, parts), components).withColumn("l", F.min(F.struct("id", "component")).over(Window.partitionBy("bucket")))
    return rows.filter("component <> l.component").select(F.col("l.id").alias("a"), F.col("id").alias("b")).distinct()


def _allowed(signed: DataFrame, met: DataFrame) -> DataFrame:
    """(a, b, n): the pairs (a, b) that may be similar."""
    both = met.join(_facts(signed, "x_"), F.col("a") == F.col("x_id")).join(_facts(signed, "y_"), F.col("b") == F.col("y_id"))
    return both.filter(_possible("x_", "y_")).select("a", "b", F.greatest("x_n", "y_n").alias("n"))


def _led(signed: DataFrame, shared: DataFrame, components: DataFrame, k: int, parts: int = PASSES) -> DataFrame:
    """(a, b, n): those of ``_met`` that may be similar."""
    return _allowed(signed, _met(shared, components, k, parts))


def _drawn(crowded: DataFrame, components: DataFrame) -> DataFrame:
    """(a, b): members of crowded buckets with some lines of their bucket's largest component, if they aren't in it.

    A line that is unlike the leader would meet each line of a large component, though a few of these often tell.
    ``crowded``: (bucket, id). Lines are drawn by an order that is the same in all buckets, so that buckets with the
    same members draw the same ones.
    """
    large = components.groupBy(F.col("component").alias("_large")).agg(F.count("*").alias("lines")).filter(F.col("lines") > CROWD)
    inside = components.join(large, F.col("component") == F.col("_large")).select(F.col("id").alias("_id"), "component")
    least = [F.min(F.struct(F.xxhash64("id", F.lit(j)).alias("x"), "id"))["id"] for j in range(LEADERS)]
    held = crowded.join(inside, F.col("id") == F.col("_id")).groupBy("bucket", "component").agg(
        F.count("*").alias("lines"), F.array_distinct(F.array(*least)).alias("drawn")).filter(F.col("lines") > CROWD)
    main = held.groupBy("bucket").agg(F.max(F.struct("lines", "component", "drawn")).alias("m"))
    main = main.select(F.col("bucket").alias("_bucket"), F.col("m.component").alias("_main"), F.col("m.drawn").alias("drawn"))
    rows = labelled(crowded.join(main, F.col("bucket") == F.col("_bucket")).select("id", "_main", "drawn"), components)
    return rows.filter("component <> _main").select(F.explode("drawn").alias("a"), F.col("id").alias("b")).distinct()


def _chains(shared: DataFrame, components: DataFrame) -> DataFrame:
    """(id, component, buckets): the buckets of every line, in order."""
    return labelled(shared.groupBy("id").agg(F.sort_array(F.collect_list("bucket")).alias("buckets")), components)


def _opened(signed: DataFrame, chains: DataFrame, k: int, parts: int = PASSES) -> DataFrame:
    """(bucket, component, before, further, id, n, p0 .., t0 ..) of the ``k``-th part of ``chains`` where a bucket has several components.

    ``before``, ``further``: the two buckets of the same line in front of this one, of any part (none: the bucket itself).
    """
    placed = chains.select(F.col("id").alias("_id"), "component", "buckets", F.posexplode("buckets").alias("at", "bucket"))
    chained = _in_part(placed, k, parts).select("_id", "component", "bucket", *[
        F.coalesce(F.when(F.col("at") >= j, F.get("buckets", F.col("at") - j)), "bucket").alias(c) for j, c in ((1, "before"), (2, "further"))])
    bucket = Window.partitionBy("bucket")
    mixed = chained.withColumns({"low": F.min("component").over(bucket), "high": F.max("component").over(bucket)}).filter("low <> high")
    return mixed.join(_facts(signed), F.col("id") == F.col("_id")).select("bucket", "component", "before", "further", "id", "n", *_counts())


def _open(signed: DataFrame, shared: DataFrame, components: DataFrame, k: int, parts: int = PASSES) -> DataFrame:
    """What ``_opened`` has of ``shared`` (bucket, id)."""
    return _opened(signed, _chains(shared, components), k, parts)


def _made_before() -> Column:
    """Whether a pair shares one of the two buckets that are in front of this one in both lines."""
    return F.expr(" OR ".join(f"(x_{a} = y_{b} AND x_{a} < x_bucket)" for a in ("before", "further") for b in ("before", "further")))


def _crossings(rows: DataFrame) -> DataFrame:
    """(a, b, n): members of one bucket and different components that may be similar."""
    x, y = ([F.col(c).alias(f"{p}_{c}") for c in rows.columns] for p in "xy")
    met = rows.select(*x).join(rows.select(*y), (F.col("x_bucket") == F.col("y_bucket"))
                               & (F.col("x_component") < F.col("y_component")) & ~_made_before() & _possible("x_", "y_"))
    return _widest(met.select(F.col("x_id").alias("a"), F.col("y_id").alias("b"), F.greatest("x_n", "y_n").alias("n")))


def line_groups(docs: DataFrame) -> DataFrame:
    """(id, component) of the lines that are similar to a line with other words."""
    with temporary(docs.sparkSession) as keep:
        words = stored(_words(docs), "lines-words", **{"parquet.dictionary.page.size": str(DICTIONARY)})
        signed = stored(_sums(words), "lines-signed")
        parts = max(1, min(PASSES, -(-signed.count() // PART)))
        nodes = signed.select("id", "simhash", "n")
        values = stored(nodes.groupBy("simhash").agg(F.count("*").alias("lines"), F.min("id").alias("first")), "lines-values")
        led = _in_passes(lambda k: _led_values(values, k, parts), "lines-met", parts).distinct()
        found = connected_components(_verified(_stars(nodes, values, led), words, "lines-stars"), "lines-first")
        with temporary(docs.sparkSession) as narrow:
            shared = narrow(stored(_narrowed(_in_passes(lambda k: _shared(words, k, parts), "lines-shared", parts)), "lines-narrowed"))
        # Only the pairs move by part; what is known of their lines is looked up once.
        led = _allowed(signed, _in_passes(lambda k: _met(shared, found, k, parts), "lines-open", parts).distinct())
        found = merged_components(found, _verified(led, words, "lines-led"), "lines-second")
        drawn = _allowed(signed, stored(_drawn(shared.filter(F.col("lines") > CROWD).select("bucket", "id"), found), "lines-crowded"))
        found = merged_components(found, _verified(drawn, words, "lines-drawn"), "lines-third")
        chains = stored(_chains(shared, found), "lines-chains")
        more = _widest(_in_passes(lambda k: _crossings(_opened(signed, chains, k, parts)), "lines-apart", parts))
        return keep(merged_components(found, _verified(more, words, "lines-more"), "lines-all"))


def removals(docs: DataFrame) -> DataFrame:
    """(doc_id, content, places, rows) of a table of (doc_id, text).

    For each document that loses lines or that occurs in several rows: the
    places of the lines that go, in order, and the number of its rows.
    """
    groups = line_groups(docs)
    occ = stored(_lines(docs).select("doc_id", "content", "pos", "id"), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "content", "pos")
    nodes = occ.groupBy("id").agg(F.min(place).alias("first"), F.count("*").alias("count"))
    nodes = labelled(nodes, groups)
    best = nodes.groupBy(F.col("component").alias("_component")).agg(F.min("first").alias("best"), F.sum("count").alias("total"))
    judged = nodes.join(best.filter("total > 1"), F.col("component") == F.col("_component")).select(F.col("id").alias("_id"), "best")
    # All lines of identical rows are among these, each as often as there are rows.
    hits = occ.join(judged, F.col("id") == F.col("_id")).groupBy("doc_id", "content", "pos").agg(
        F.count("*").alias("rows"), F.min((~F.col("best").eqNullSafe(place)).cast("int")).alias("lost"))
    return hits.groupBy("doc_id", "content").agg(
        F.array_sort(F.collect_list(F.when(F.col("lost") == 1, F.col("pos")))).alias("places"), F.max("rows").alias("rows")
    ).filter((F.size("places") > 0) | (F.col("rows") > 1))


def _without(lines: Column, places: Column) -> Column:
    """``lines`` without those at ``places`` (ascending, from 0): the stretches between them."""
    start = lambda j: F.when(j == 0, 0).otherwise(F.element_at(places, F.greatest(j, F.lit(1))) + 1)
    end = lambda j: F.when(j == F.size(places), F.size(lines)).otherwise(
        F.element_at(places, F.least(j + 1, F.size(places))))
    return F.when(F.size(places) == 0, lines).otherwise(F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(places)), lambda j: F.slice(lines, start(j) + 1, end(j) - start(j)))))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed_col: str | None = None) -> DataFrame:
    """``docs`` with repeated lines taken out of the text; ``removed_col``: their number, if asked for."""
    columns = docs.columns
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    with temporary(docs.sparkSession) as keep:
        gone = keep(stored(removals(plain), "lines-removals"))
    gone = gone.select(
        F.col("doc_id").alias("_id"), F.col("content").alias("_was"), F.col("places").alias("_places"), F.col("rows").alias("_rows"))
    text = F.col(text_col)
    joined = docs.withColumn("_content", F.when(text.isNotNull(), content_of(text))).join(
        gone, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_content") == F.col("_was")), "left")
    lines = F.split(text, "\n")
    order = Window.partitionBy("_id", "_was").orderBy(F.lit(0))
    rows = joined.filter("_rows IS NULL OR _rows = 1").withColumn("_nth", F.lit(1))
    if not gone.filter("_rows > 1").isEmpty():  # else the join would be planned twice for nothing
        rows = rows.unionByName(joined.filter("_rows > 1").withColumn("_nth", F.row_number().over(order)))
    kept = (F.when(F.col("_places").isNull(), lines)
            .when(F.col("_nth") > 1, F.filter(lines, lambda x: F.size(line_words(x)) == 0))
            .otherwise(_without(lines, F.col("_places"))))
    rows = rows.withColumn("_lines", kept)
    if removed_col:
        rows = rows.withColumn(removed_col, F.coalesce(F.size(lines) - F.size("_lines"), F.lit(0)))
        columns = [*columns, removed_col]
    new = F.when(F.col("_places").isNull(), text).otherwise(F.array_join("_lines", "\n"))
    return rows.withColumn(text_col, new).select(*columns)
