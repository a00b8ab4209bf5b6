from __future__ import annotations

import collections
import re

from llm.helpers import ODD, documents, empty, odd, prose
from transitlens.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    inside = {k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_counts(spark):
    rows = Q.quality(odd(spark)).collect()
    assert len(rows) == len(ODD)
    got = sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in rows)
    assert got == sorted(str((i, *brute(t))) for i, t, _, _ in ODD)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept is not None and not (r.base_failed and r.kept)


def test_thresholds_follow_the_group(spark):
    """One group has many symbols throughout and keeps its documents; in the other they stand out."""
    plain = [(i, prose(i, 120), "en", "a") for i in range(40)]
    signs = [(100 + i, " ".join(w + "#$" for w in prose(i, 120).split()), "en", "b") for i in range(40)]
    stray = [(200, " ".join(w + "#$" for w in prose(9, 120).split()), "en", "a")]
    kept = {r.doc_id: r.kept for r in Q.quality(documents(spark, plain + signs + stray)).collect()}
    assert kept.pop(200) is False and all(kept.values())
    docs = documents(spark, plain + signs + stray)
    left = Q.filter_documents(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == set(kept)


def test_sketches_merge(spark):
    """Sketches of the parts, added up, are the sketch of the whole."""
    rows = [(i, prose(i, 60 + i), "en", "ab"[i % 2]) for i in range(30)]
    stats = Q.with_stats(documents(spark, rows))
    whole = Q.sketches(stats, ["lang"])
    parts = Q.merged(Q.sketches(stats, ["lang", "source"]), ["lang"])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def test_empty_table(spark):
    assert Q.quality(empty(spark)).count() == 0 and Q.filter_documents(empty(spark)).count() == 0
