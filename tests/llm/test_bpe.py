"""BPE coding and prefix counts against the tokenizers library."""

from __future__ import annotations

import hashlib
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.helpers import ODD, empty, odd
from transitlens.llm import bpe_coding, token_counts
from transitlens.llm.bpe import automaton

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
TEXT = st.lists(st.sampled_from(["a", "the", "tion", "'", "re", "ll", " ", "  ", "\n", "\t", "!!", "<|endoftext|>", "<|startoftext|>",
                                 "漢字", "😀", "é", "é", "İ", "ΑΣ", "12", "²", "_", "\x1c", "\x85", "՘", "Ᲊ"])
                | st.text(max_size=4), max_size=12).map("".join)


@pytest.fixture(scope="module")
def tools():
    return Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_words_as_the_library(tools, text):
    ids = tools[0].encode(text, add_special_tokens=False).ids
    coded, decoded = bpe_coding.codes(WORD).encode(text)
    assert list(struct.unpack(f"<{len(coded) // 4}I", coded)) == ids
    assert decoded == tools[0].decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_every_prefix_as_the_library(tools, text):
    counts = token_counts.piece_counts(BYTE).prefixes(text)
    assert counts.tolist() == [len(tools[1].encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abnt", min_size=1, max_size=40))
def test_automaton_is_the_merges(word):
    """Against merging by priority, step by step."""
    table = automaton(BYTE)
    parts = list(word)
    rank = {(table.labels[table.left[i]], s[len(table.labels[table.left[i]]):]): table.born[i]
            for i, s in table.labels.items() if i < len(table.left) and table.left[i] >= 0 and len(s) <= len(word)}
    while True:
        best = min((rank.get(p, 1 << 40) for p in zip(parts, parts[1:])), default=1 << 40)
        if best == 1 << 40:
            break
        i, out = 0, []
        while i < len(parts):
            if i + 1 < len(parts) and rank.get((parts[i], parts[i + 1])) == best:
                out.append(parts[i] + parts[i + 1])
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
    assert [table.labels[i] for i in table.encode_word(word)] == parts


def test_odd_rows(spark, tools):
    rows = bpe_coding.encode(odd(spark), WORD, with_decoded=True).collect()
    assert len(rows) == len(ODD)
    want = sorted(str((i, tools[0].encode(t or "", add_special_tokens=False).ids)) for i, t, _, _ in ODD)
    assert sorted(str((r.doc_id, list(r.ids))) for r in rows) == want
    for r in rows:
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(r.ids)}I", *r.ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    back = bpe_coding.decode(bpe_coding.encode(odd(spark), WORD), WORD).collect()
    assert sorted(r.decoded for r in back) == sorted(r.decoded for r in rows)
    got = token_counts.budget_answers(odd(spark), BYTE, 20).collect()
    want = sorted(str((i, len((t or "").encode()), len(tools[1].encode(t or "", add_special_tokens=False).ids))) for i, t, _, _ in ODD)
    assert sorted(str((r.doc_id, r.n_bytes, r.n_tokens)) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 20) for r in got)
    table = {r.doc_id: r.prefix_tokens for r in token_counts.prefix_table(odd(spark), BYTE).collect()}
    assert table[2] == [0] and len(table[7]) == len(ODD[9][1]) + 1


def test_empty_table(spark):
    assert bpe_coding.encode(empty(spark), WORD).count() == 0
    assert token_counts.budget_answers(empty(spark), BYTE, 20).count() == 0


def test_pieces_in_use_are_kept(monkeypatch):
    """A full cache gives up what isn't used, not everything; counts are those of a fresh automaton."""
    table, made = token_counts.PieceCounts(automaton(BYTE)), []
    monkeypatch.setattr(token_counts, "PIECES_KEPT", 20)
    count = table.table.prefix_counts
    monkeypatch.setattr(table.table, "prefix_counts", lambda word: made.append(word) or count(word))
    for i in range(100):
        table.prefixes(f"often stem{chr(97 + i % 26)}ming{chr(97 + i // 26)}s")
    assert made.count("often") == 1 and len(table) + len(table.older) <= 20
    words = ["internationalisation", "internationally", "internment", "\u00e9t\u00e9"]
    fresh = [token_counts.PieceCounts(type(table.table)(BYTE)).prefixes(w).tolist() for w in words]
    assert [table.prefixes(w).tolist() for w in words] == fresh
