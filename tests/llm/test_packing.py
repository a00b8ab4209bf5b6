"""Packing: ids against the library, places against the rules, numbers of sequences against bounds."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.helpers import documents, empty, odd, prose
from transitlens.llm import packing
from transitlens.llm.byte_ids import ByteIds
from transitlens.llm.packing_plan import best_fit, configurations, grouped, plan

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_librarys(library):
    rng, coder = random.Random(4), ByteIds(PATH)
    parts = ["a", "s", "t", "re", "ve", "ll", "m", "d", "'", "''", " ", "  ", "\n", "\t", "\xa0", "1", "½", "²", "_", "!", "é", "漢", "\U0001F600",
             "\x1c", "　", "S", "ſ", "٣", "\x85", "-", "<|", "'s", " '", "the"]
    odd_parts = [*parts, "<|endoftext|>", "͸"]
    for pool in (parts, odd_parts):
        for _ in range(60):
            texts = [rng.choice([None, ""]) if rng.random() < 0.1 else "".join(rng.choice(pool) for _ in range(rng.randint(1, 14))) for _ in range(30)]
            for text, got in zip(texts, coder.encode(texts), strict=True):
                assert got.tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def check_places(rows, capacity):
    """Every sequence is filled from 0 without a gap and within the capacity."""
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end and length >= 1
            end += length
        assert end <= capacity
    return len(by_sequence)


def check_pieces(rows, docs, library, capacity):
    got, want = Counter(), Counter()
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
    for i, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        n = -(-len(ids) // capacity)
        head = len(ids) - (n - 1) * capacity
        for k in range(n):
            a, b = (0, head) if k == 0 else (head + (k - 1) * capacity, head + k * capacity)
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert got == want


@pytest.mark.parametrize("capacity", [2048, 64, 1])
def test_pack(spark, library, capacity):
    rng = random.Random(5)
    docs = [(i % 90, prose(i, rng.choice([1, 5, 20, 60, 200, 900])), "en", "s") for i in range(60 if capacity == 1 else 120)]
    docs += [(7, "same", "en", "s")] * 40 + [(None, None, None, None), (8, "", "en", "s")]
    rows = packing.pack(documents(spark, docs).repartition(6), PATH, capacity).collect()
    check_pieces(rows, [d[:2] for d in docs], library, capacity)
    used = check_places(rows, capacity)
    total = sum(r.length for r in rows)
    assert used <= 1.02 * total / capacity + 1


def test_odd_rows(spark, library):
    rows = packing.pack(odd(spark), PATH).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in odd(spark).collect()], library, 2048)
    check_places(rows, 2048)
    assert packing.pack(empty(spark), PATH).count() == 0


def test_sequences_hold_the_ids(spark, library):
    docs = [(i, prose(i, 30 + i), "en", "s") for i in range(40)]
    packed = packing.pack(documents(spark, docs).repartition(3), PATH, 256, with_ids=True)
    packed.cache()
    ids = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert max(map(len, ids.values())) <= 256
    for r in packed.collect():
        assert ids[r.sequence_id][r.offset:r.offset + r.length] == r.ids
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    packed.unpersist()


def slots_as_sequences(counts, slots):
    """sequence -> sorted (offset, length), with every piece of every length placed once."""
    seen, out = Counter(), {}
    for s in slots:
        for number in range(s.first, s.last):
            seat, place = divmod(number - s.first, s.each)
            out.setdefault(s.sequence + seat, []).append((s.offset + place * s.length, s.length))
            seen[s.length, number] += 1
    assert seen == Counter((length, i) for length, n in counts.items() for i in range(n))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_plans_place_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 64, 500, 2048])
    counts = Counter(min(capacity, int(rng.paretovariate(0.7))) if rng.random() < 0.5 else rng.randint(1, capacity) for _ in range(rng.choice([1, 30, 4000])))
    counts[capacity // 3 + 1] += rng.choice([0, 1500])  # a third of all pieces has one length
    counts = {k: n for k, n in counts.items() if n and k <= capacity}
    sequences = slots_as_sequences(counts, plan(counts, capacity))
    assert sorted(sequences) == list(range(len(sequences)))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity


def test_configurations_reach_the_optimum():
    """Best fit by falling size alone puts two of 48 together and wastes room; the program does not."""
    counts = {48: 600, 37: 600, 26: 1500}  # 48 + 26 + 26 and 37 + 37 + 26
    assert len(slots_as_sequences(counts, plan(counts, 100))) <= 901
    assert sum(c.number for c in best_fit([], counts, 100)) >= 930
    assert sum(times for times, _ in configurations(counts, 100)) >= 895


def test_groups_are_equal_and_round_up():
    counts = {n: 10 for n in range(300, 700)}
    groups = grouped(counts, 8)
    assert [sum(n for _, n in g) for g in groups.values()] == [500] * 8
    assert all(size == max(length for length, _ in g) for size, g in groups.items())
    assert sum((Counter(dict(g)) for g in groups.values()), Counter()) == Counter(counts)
    assert plan({}, 10) == []
