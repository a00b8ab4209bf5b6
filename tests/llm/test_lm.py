from __future__ import annotations

import collections
import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.helpers import ODD, documents, empty, odd, prose
from transitlens.llm import lm_scoring as S
from transitlens.llm import lm_trie as E

NUMBERS = st.lists(st.integers(0, (1 << 62) - 1), min_size=1, max_size=300, unique=True).map(sorted)


@settings(max_examples=100, deadline=None)
@given(NUMBERS, NUMBERS)
def test_elias_fano(values, asked):
    values, asked = np.array(values, np.int64), np.array(sorted({*asked, *values[::2]}), np.int64)
    sequence = E.EliasFano(E.EliasFano.build(values))
    assert (sequence.get(np.arange(len(values))) == values).all()
    places = dict(zip(values.tolist(), range(len(values))))
    assert sequence.find(asked).tolist() == [places.get(x, -1) for x in asked.tolist()]


def test_chunks(monkeypatch):
    monkeypatch.setattr(E, "CHUNK", 7)
    values = np.sort(np.random.default_rng(1).choice(10_000, 100, replace=False)).astype(np.int64)
    sequence = E.EliasFano(E.EliasFano.build(values))
    assert (sequence.find(values) == np.arange(100)).all() and (sequence.get(np.arange(100)) == values).all()


def expected(rows):
    """The model from counters."""
    texts = [[w.lower() for w in (t or "").encode().split()] + [b"\n"] for _, t, _, _ in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, *_ in rows]
    one, two = collections.Counter(), collections.Counter()
    for t, h in zip(texts, held):
        if not h:
            one.update(t)
            two.update(zip([b"\n", *t], t))
    norm = sum(one.values()) + len(one) + 1
    context, kinds = collections.Counter(), collections.Counter()
    for (v, _), c in two.items():
        context[v] += c
        kinds[v] += 1
    code = lambda x: min(65535, round(-x * E.STEPS))
    out = []
    for (i, *_), t, h in zip(rows, texts, held):
        cost = 0
        for v, w in zip([b"\n", *t], t):
            if (v, w) in two:
                cost += code(math.log10((two[v, w] - S.DISCOUNT) / context[v]))
            else:
                cost += code(math.log10(S.DISCOUNT * kinds[v] / context[v])) if v in context else 0
                cost += code(math.log10((one[w] + 1) / norm))
        out.append((i, h, len(t), sum(one[w] > 0 for w in t), sum(one.values()),
                    sum(math.log10((one[w] + 1) / norm) for w in t), -cost / E.STEPS))
    return sorted(out, key=str)


@pytest.mark.parametrize("tokens", [6_000_000, 500])
def test_against_counters(spark, monkeypatch, tokens):
    """With few tokens to a shard there are many shards, and hot contexts."""
    monkeypatch.setattr(S, "SHARD_TOKENS", tokens)
    rows = [(i, prose(i, 40) + " the" * (i % 5) + " The end" * (i % 3), "en", "a") for i in range(60)] + ODD
    got = sorted((tuple(r) for r in S.score_documents(documents(spark, rows)).collect()), key=lambda r: str(r[:5]))
    want = sorted(expected(rows), key=lambda r: str(r[:5]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    close = lambda x: sorted(round(v, 6) for v in x)
    assert close(r[5] for r in got) == pytest.approx(close(r[5] for r in want), abs=1e-5)
    assert close(r[6] for r in got) == pytest.approx(close(r[6] for r in want), abs=2e-3)


def test_odd_rows(spark):
    assert S.score_documents(odd(spark)).count() == len(ODD)
    assert S.score_documents(empty(spark)).count() == 0
    alone = S.score_documents(documents(spark, [(i, "a b", None, None) for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2]))
    assert {(r.n_known, r.train_tokens) for r in alone.collect()} == {(0, 0)}


def test_a_block_for_each_batch_and_shard(spark, monkeypatch):
    """A shard makes one row for a batch, not one for each of its documents; hot contexts add shards by their size."""
    kept, store = {}, S.stored
    monkeypatch.setattr(S, "stored", lambda df, name: kept.setdefault(name, store(df, name)))
    monkeypatch.setattr(S, "SHARD_TOKENS", 500)
    rows = [(i, prose(i, 40) + " the" * 20, "en", "a") for i in range(60)]
    assert S.score_documents(documents(spark, rows).coalesce(1)).count() == 60
    for name in ("lm-words", "lm-pairs"):
        kinds = collections.Counter(r.kind for r in kept[name].select("kind").collect())
        assert kinds["keys"] == 1 and 1 < kinds["doc"] + kinds["codes"] < 40
