"""Collocations against counting in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from llm.helpers import documents, empty, odd, prose
from transitlens.llm import collocation


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counted(rows):
    """(f, n): frequencies of (lang, words) and words in each language."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    return f, n


def expected(rows, least, top):
    f, n = counted(rows)
    found = {key: a for key, a in f.items() if len(key[1]) >= 2 and a >= least}
    covered = Counter()
    for (lang, w), a in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                covered[lang, w[i:i + k]] = max(covered[lang, w[i:i + k]], a)
    out = []
    for (lang, w), a in found.items():
        if 100 * covered[lang, w] >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    out.sort()
    rank, rows = Counter(), []
    for lang, score, a, phrase, left, right in out:
        rank[lang] += 1
        if rank[lang] <= top:
            rows.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return rows


def texts(seed, n):
    rng = random.Random(seed)
    words = ["Ab", "cd", "É", "ef", "of", "the", "gh", "12", "x-y", "漢"]
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " \x1c ", "\xa0"]
    return [(rng.choice(["en", "de", None, "und", "a b"]),
             "".join(rng.choice(words[:rng.randint(1, 10)]) + rng.choice(ends) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("budget", [collocation.BUDGET, 400, 16, 1])
def test_equals_counting_whatever_the_budget(spark, budget, monkeypatch):
    """Small budgets extend prefixes to two, three and four words."""
    monkeypatch.setattr(collocation, "CHUNK", 200)
    rows = texts(1, 300)
    docs = documents(spark, [(i, t, lang, "s") for i, (lang, t) in enumerate(rows)]).repartition(5)
    got = [tuple(r) for r in collocation.collocations(docs, least=5, top=40, budget=budget).collect()]
    assert sorted(got) == sorted(expected(rows, 5, 40)) and len(got) > 100


def test_all_phrases_have_exact_counts(spark):
    rows = texts(2, 200)
    docs = documents(spark, [(i, t, lang, "s") for i, (lang, t) in enumerate(rows)])
    f, n = counted(rows)
    phrases, totals = collocation.phrase_counts(docs.selectExpr("coalesce(lang, 'und') AS lang", "text"), 3, budget=100)
    got = {(r.lang, tuple(r.phrase.split(" "))): r.f for r in phrases.collect()}
    assert got == {key: a for key, a in f.items() if a >= 3}
    assert {r.lang: r.n for r in totals.collect() if r.n} == {lang: a for lang, a in n.items() if a}


def test_ties_and_covered_phrases(spark):
    rows = [("en", "new york city hall")] * 40 + [("en", "new york")] * 5 + [("en", "b a")] * 30 + [("en", "d c")] * 30
    docs = documents(spark, [(1, t, lang, "s") for lang, t in rows])
    got = [tuple(r) for r in collocation.collocations(docs).orderBy("rank").collect()]
    assert got == expected(rows, 30, 2000)
    assert [r[2] for r in got] == ["b a", "d c", "new york city hall"]


def test_odd_rows(spark):
    rows = [(r.lang, r.text) for r in odd(spark).collect()]
    got = sorted(tuple(r) for r in collocation.collocations(odd(spark), least=2).collect())
    assert got == sorted(expected(rows, 2, 2000)) and got
    assert collocation.collocations(empty(spark)).count() == 0


def test_long_text_is_cut_between_pieces():
    text = prose(3, 5000) + " no end " * 900
    parts = list(collocation.blocks(text, 1000))
    assert len(parts) > 10 and [w for b in parts for w in collocation.words_of(b)] == collocation.words_of(next(collocation.blocks(text)))
    assert list(collocation.blocks(None)) == [b""]
