"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Base counts are taken from every whole text. Ratios of these counts go into
sketches, one per language, source and measure: counts of values rounded down
to ``SIGNIFICANT`` binary digits, so that sketches merge by adding counts, are
exact to that precision and have a bounded number of buckets. Thresholds are
read from them (quartiles and a multiple of the distance between them, plus a
tolerance for measures that hardly vary), and documents are joined with the
thresholds of their group. Sketches are made of documents that pass the base
rule; a group with fewer than ``MIN_GROUP`` of these takes its language's
thresholds, from the merged sketches of its sources.

Defined cases: a null or empty text has no words and fails the base rule; null
languages and sources are groups of their own; repeated rows each count and
give one row each; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.llm.common import WORD_PATTERN, keep_only, ready, stored

WORDS = re.compile(WORD_PATTERN)
SYMBOLS = re.compile(r"[#*$%&|<>]")

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words"]

#: measure: (count, of, tolerance per 1000 of, whether low values fail too)
MEASURES = {
    "symbols": ("n_symbols", "n_words", 100, False),
    "dup_lines": ("n_dup_lines", "n_lines", 400, False),
    "repeats": ("n_repeat_words", "n_words", 250, False),
    "word_length": ("word_chars", "n_words", 1000, True),
    "upper": ("n_upper_words", "n_words", 200, False),
}
SIGNIFICANT = 7
MIN_GROUP = 30
SPREAD = 3
#: Texts that are counted together.
SLICE = 1000


def repeated_words(words: list[str]) -> int:
    """Words inside 3-word windows that occur twice or more in the text."""
    n = len(words)
    codes: dict[str, int] = {}
    ids = [codes.setdefault(w, len(codes)) for w in words]
    size = len(codes)
    if n < 4 or size == n:
        return 0
    a = np.array(ids, np.int64)
    pairs = a[:-2] * size + a[1:-1]
    if size > 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs * size + a[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k:n - 2 + k] |= twice
    return int(inside.sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """``STATS`` of one text."""
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), len(SYMBOLS.findall(text)), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), sum(map(str.isupper, words)))


STATS_TYPE = T.StructType([T.StructField(n, T.LongType()) for n in STATS])


@F.arrow_udf(STATS_TYPE)
def stats_of(texts: pa.Array) -> pa.Array:
    keep_only()
    slices = (texts.slice(at, SLICE).to_pylist() for at in range(0, len(texts), SLICE))
    rows = np.array([text_stats(t) for some in slices for t in some], np.int64).reshape(-1, len(STATS))
    return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(STATS))], STATS)


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the struct column ``_stats`` and the boolean ``_base_failed``."""
    ready(docs.sparkSession)
    s = F.col("_stats")
    return docs.withColumn("_stats", stats_of(F.col(text_col))).withColumn(
        "_base_failed", (s.n_words < 50) | (100 * s.n_repeat_words > 50 * s.n_words))


def measure(name: str) -> Column:
    """A measure in thousandths, in whole numbers."""
    count, of = MEASURES[name][:2]
    return F.floor(F.try_divide(1000 * F.col(f"_stats.{count}"), F.col(f"_stats.{of}"))).cast("long")


def rounded(value: Column) -> Column:
    """A whole number with all but its leading ``SIGNIFICANT`` binary digits cleared."""
    step = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.length(F.bin(value)) - SIGNIFICANT)).cast("long")
    return value - value % step


def sketches(docs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, measure, bucket, n: the sketches of a table that ``with_stats`` made."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), rounded(measure(m)).alias("bucket"))
                                 for m in MEASURES]))
    return (docs.filter(~F.col("_base_failed")).select(*keys, values.alias("v"))
            .select(*keys, "v.*").filter("bucket IS NOT NULL")
            .groupBy(*keys, "measure", "bucket").agg(F.count("*").alias("n")))


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """keys, group_docs and for each measure <measure>_low and <measure>_high."""
    by = Window.partitionBy(*keys, "measure")
    below = by.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.withColumns({"upto": F.sum("n").over(below), "total": F.sum("n").over(by)})
    quartile = lambda p: F.min(F.when(F.col("upto") * 100 >= F.col("total") * p, F.col("bucket")))
    found = ranked.groupBy(*keys, "measure").agg(quartile(25).alias("q25"), quartile(75).alias("q75"),
                                                 F.max("total").alias("total"))
    out = [F.max("total").alias("group_docs")]
    spread = SPREAD * (F.col("q75") - F.col("q25"))
    for m, (_, _, tolerance, both) in MEASURES.items():
        mine = F.col("measure") == m
        out.append(F.max(F.when(mine, F.col("q75") + spread + tolerance)).alias(f"{m}_high"))
        if both:
            out.append(F.max(F.when(mine, F.col("q25") - spread - tolerance)).alias(f"{m}_low"))
    return found.groupBy(*keys).agg(*out)


def thresholds(sketch: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row for each language and source: its fences, or its language's if it is small."""
    own = fences(sketch, [lang_col, source_col])
    wide = fences(merged(sketch, [lang_col]), [lang_col]).withColumnRenamed(lang_col, "_lang")
    names = [c for c in own.columns if c not in (lang_col, source_col, "group_docs")]
    wide = wide.select("_lang", *[F.col(c).alias(f"_{c}") for c in names])
    small = F.col("group_docs") < MIN_GROUP
    return (own.join(wide, F.col(lang_col).eqNullSafe(F.col("_lang")), "left")
            .select(lang_col, source_col, *[F.when(small, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in names]))


def judged(docs: DataFrame, limits: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """A table that ``with_stats`` made, with the boolean ``_kept``."""
    names = [c for c in limits.columns if c not in (lang_col, source_col)]
    limits = limits.select(F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source"),
                           *[F.col(c).alias(f"_{c}") for c in names])
    inside = ~F.col("_base_failed")
    for m, (_, _, _, both) in MEASURES.items():
        inside &= F.coalesce(measure(m) <= F.col(f"_{m}_high"), F.lit(True))
        if both:
            inside &= F.coalesce(measure(m) >= F.col(f"_{m}_low"), F.lit(True))
    joined = docs.join(limits, F.col(lang_col).eqNullSafe(F.col("_lang")) & F.col(source_col).eqNullSafe(F.col("_source")), "left")
    return joined.withColumn("_kept", inside).drop("_lang", "_source", *[f"_{c}" for c in names])


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source") -> DataFrame:
    """doc_id, the base counts, base_failed and kept, one row for each row of ``docs``.

    The counts are stored once (no text), so that texts are read one time.
    """
    counted = with_stats(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                                     F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))).drop("text")
    counted = stored(counted, "quality-stats")
    limits = thresholds(stored(sketches(counted, ["lang", "source"]), "quality-sketches"))
    return judged(counted, limits).select(
        "doc_id", *[F.col(f"_stats.{c}").alias(c) for c in STATS],
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def filter_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Texts never move: they are counted once for the sketches and once more
    where they are filtered.
    """
    columns = [F.col(c) for c in docs.columns]
    plain = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    limits = thresholds(stored(sketches(with_stats(plain), ["lang", "source"]), "quality-sketches"))
    limits = limits.withColumnsRenamed({"lang": lang_col, "source": source_col})
    limits = stored(limits, "quality-limits")
    return judged(with_stats(docs, text_col), limits, lang_col, source_col).filter("_kept").select(*columns)


ORACLE_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, lang, source FROM documents),
words AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
line_counts AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
                FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
windows AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
            FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM words)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
stats AS (SELECT docs.r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
            CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
            CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
            coalesce(n_lines, 0) AS n_lines,
            CAST(len(list_filter(w, lambda x: upper(x) = x AND lower(x) <> x)) AS BIGINT) AS n_upper_words
          FROM docs JOIN words USING (r) LEFT JOIN line_counts USING (r) LEFT JOIN repeats USING (r)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats),
measures AS (SELECT r, lang, source, base_failed, measure, v FROM based, LATERAL (VALUES
            ('symbols', 1000 * n_symbols // nullif(n_words, 0)), ('dup_lines', 1000 * n_dup_lines // nullif(n_lines, 0)),
            ('repeats', 1000 * n_repeat_words // nullif(n_words, 0)), ('word_length', 1000 * word_chars // nullif(n_words, 0)),
            ('upper', 1000 * n_upper_words // nullif(n_words, 0))) AS t(measure, v)),
buckets AS (SELECT lang, source, measure, v - v % CAST(pow(2, greatest(0, length(bin(v)) - 7)) AS BIGINT) AS bucket
            FROM measures WHERE NOT base_failed AND v IS NOT NULL),
level AS (SELECT 0 AS wide, lang, source, measure, bucket, count(*) AS n FROM buckets GROUP BY ALL
          UNION ALL SELECT 1, lang, NULL, measure, bucket, count(*) FROM buckets GROUP BY ALL),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY wide, lang, source, measure ORDER BY bucket) AS upto,
             sum(n) OVER (PARTITION BY wide, lang, source, measure) AS total FROM level),
quartiles AS (SELECT wide, lang, source, measure, max(total) AS total, min(bucket) FILTER (upto * 100 >= total * 25) AS q25,
                min(bucket) FILTER (upto * 100 >= total * 75) AS q75 FROM ranked GROUP BY ALL),
slack(measure, tolerance, low) AS (VALUES ('symbols', 100, false), ('dup_lines', 400, false), ('repeats', 250, false),
                                          ('word_length', 1000, true), ('upper', 200, false)),
fence AS (SELECT wide, lang, source, q.measure, max(total) OVER (PARTITION BY wide, lang, source) AS group_docs,
            q75 + 3 * (q75 - q25) + tolerance AS high, CASE WHEN low THEN q25 - 3 * (q75 - q25) - tolerance END AS low
          FROM quartiles q JOIN slack s ON q.measure = s.measure),
limits AS (SELECT o.lang, o.source, o.measure, CASE WHEN o.group_docs < 30 THEN w.high ELSE o.high END AS high,
             CASE WHEN o.group_docs < 30 THEN w.low ELSE o.low END AS low
           FROM (SELECT * FROM fence WHERE wide = 0) o
           LEFT JOIN (SELECT * FROM fence WHERE wide = 1) w ON o.lang IS NOT DISTINCT FROM w.lang AND o.measure = w.measure),
outside AS (SELECT DISTINCT m.r FROM measures m JOIN limits l ON m.lang IS NOT DISTINCT FROM l.lang
            AND m.source IS NOT DISTINCT FROM l.source AND m.measure = l.measure WHERE m.v > l.high OR m.v < l.low)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM outside) AS kept FROM based
"""
