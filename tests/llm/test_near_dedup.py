from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.helpers import ODD, WORDS, documents, empty, odd, prose
from transitlens.llm import near_dedup as N

SMALL = st.lists(st.integers(0, 3), max_size=16)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=500, deadline=None)
@given(SMALL, SMALL, st.integers(0, 12))
def test_band(a, b, most):
    assert N.band_distance(a, b, most) == min(distance(a, b), most + 1)


def test_sketch_keeps_order():
    """The same words in another order share far fewer sketches than a copy with edits."""
    rng = np.random.default_rng(2)
    base = rng.integers(1, 1 << 60, 400).astype(np.uint64)
    edited = base.copy()
    edited[::80] = 7
    halves = np.concatenate([base[200:], base[:200]])
    a, b, c = N.sketch([base, edited, halves])
    assert (a == b).sum() >= 1 and (a == c).sum() < (a == b).sum()


def corpus():
    rng, rows = random.Random(5), []
    for group in range(12):
        words = prose(1000 + group, 150).split()
        for _ in range(4):
            near = list(words)
            for _ in range(rng.randint(0, 5)):
                near[rng.randrange(len(near))] = rng.choice(WORDS)
            rows.append((len(rows), " ".join(near), "en", "a"))
    for _ in range(60):  # a hot group of copies with one edit each
        near = prose(77, 120).split()
        near[rng.randrange(len(near))] = "edit%d" % len(rows)
        rows.append((len(rows), " ".join(near), "en", "a"))
    shared = prose(5, 60)  # a passage that unlike texts share
    rows += [(len(rows) + i, shared + "\n" + prose(2000 + i, 200), "en", "a") for i in range(30)]
    rows += [(len(rows) + i, prose(3000 + i, 100), "en", "b") for i in range(40)]
    return rows


def brute(rows):
    """Classes by comparing all pairs."""
    words = {i: N.WORD.findall((t or "").lower()) for i, t, _, _ in rows}
    root = {i: i for i in words}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(words)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if find(a) != find(b) and N.similar(words[a], words[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def test_against_all_pairs(spark):
    rows = corpus()
    got = {r.doc_id: r.class_id for r in N.near_duplicates(documents(spark, rows)).collect()}
    assert got == brute(rows)
    docs = documents(spark, rows)
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_edited_copies_that_share_a_passage_with_others(spark, monkeypatch):
    """Copies with few sketches in common, whose buckets also hold many other texts."""
    rows, shared = [], prose(5, 78).split()
    for group in range(25):
        own = ["own%dof%d" % (i, group) for i in range(22)]
        edited = ["edit%dof%d" % (i, group) if i % 5 == 0 else w for i, w in enumerate(own)]  # in every k-mer
        rows += [(2 * group, " ".join(shared + own), "en", "a"), (2 * group + 1, " ".join(shared + edited), "en", "a")]
    want = brute(rows)
    assert len(set(want.values())) == 25
    assert {r.doc_id: r.class_id for r in N.near_duplicates(documents(spark, rows)).collect()} == want
    monkeypatch.setattr(N, "HOT", 3)
    assert {r.doc_id: r.class_id for r in N.near_duplicates(documents(spark, rows)).collect()} == want


def edited(rng, words, edits):
    """``words`` with so many random edits."""
    words = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        new = "new%d" % rng.randrange(10**9)
        words[at:at + 1] = ([new], [words[at], new], [])[kind if len(words) > 4 else 0]
    return words


def test_recall_by_length_and_similarity(spark):
    """Of pairs with random edits at each similarity and length, at least 0.9 are found."""
    rng, rows, wanted = random.Random(8), [], {}
    for length in (5, 6, 8, 12, 20, 40, 55, 66, 80, 150, 300):
        for least in (0.95, 0.9, 0.85, 0.8):
            for _ in range(30):
                base = ["w%d" % rng.randrange(10**9) for _ in range(length)]
                other = edited(rng, base, int(length * (1 - least) + 1e-9))
                if base != other and N.similar(base, other):
                    wanted.setdefault((length, least), []).append(len(rows))
                    rows += [(len(rows), " ".join(base), "en", "a"), (len(rows) + 1, " ".join(other), "en", "a")]
    got = {r.doc_id: r.class_id for r in N.near_duplicates(documents(spark, rows)).collect()}
    recall = {k: sum(got[i] == got[i + 1] for i in ids) / len(ids) for k, ids in wanted.items() if len(ids) > 9}
    assert len(recall) > 30 and min(recall.values()) >= 0.9, recall
    assert all(c in (i, i - 1) for i, c in got.items())


def test_short_texts(spark):
    rows = [(1, "alpha beta gamma delta", "en", "a"), (2, "alpha beta gamma delta epsilon", "en", "a"),
            (3, "alpha", "en", "a"), (4, "alpha.", "en", "a"), (5, "alpha beta", "en", "a"), (6, "beta alpha", "en", "a")]
    got = {r.doc_id: r.class_id for r in N.near_duplicates(documents(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6}


def test_hot_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(N, "HOT", 3)
    rows = corpus()
    assert {r.doc_id: r.class_id for r in N.near_duplicates(documents(spark, rows)).collect()} == brute(rows)


def test_odd_rows(spark):
    got = N.near_duplicates(odd(spark)).collect()
    assert len(got) == len(ODD)
    by_class = {}
    for r in got:
        by_class.setdefault(r.class_id, []).append(r)
    assert len(by_class) == len(ODD) - 1  # only the equal rows are copies; names are unique
    assert sorted(len(v) for v in by_class.values()) == [1] * (len(ODD) - 2) + [2]
    assert all(r.class_rows == len(by_class[r.class_id]) for r in got)
    ids = [r.doc_id for r in got]
    assert all(r.class_id == r.doc_id if ids.count(r.doc_id) == 1 and r.doc_id is not None else r.class_id < 0 for r in got)
    kept = N.keep_one(odd(spark)).collect()
    assert len(kept) == len(ODD) - 1  # the repeated row
    assert N.near_duplicates(empty(spark)).count() == 0 and N.keep_one(empty(spark)).count() == 0


def test_counts_rule_pairs_out(spark):
    """Words that differ an even number of times leave the parities alone, but not the counts; similar pairs always pass."""
    base = [f"w{i}" for i in range(100)]
    rng, rows = random.Random(5), [(0, " ".join([*base, *["also"] * 60])), (1, " ".join([*base, *["never"] * 60]))]
    for i in range(2, 30):
        near = list(base) if i % 2 else [*base, *["also"] * 60]
        for _ in range(len(near) // 5):
            at, kind = rng.randrange(len(near)), rng.randrange(3)
            near[at:at + 1] = [["also"], [], [near[at], f"n{rng.randrange(5)}"]][kind]
        rows.append((i, " ".join(near)))
    made = N.sketched(spark.createDataFrame(rows, "doc_id long, text string")).withColumnRenamed("doc_id", "id").cache()
    asked = [(a, b) for a, _ in rows for b, _ in rows if a < b]
    words = {i: N.word_hashes(t).tolist() for i, t in rows}
    got = {(r.a, r.b) for r in N.allowed(spark.createDataFrame(asked, "a long, b long"), made).collect()}
    assert (0, 1) not in got
    assert {(a, b) for a, b in asked if N.similar(words[a], words[b])} <= got


def test_a_pair_is_made_once(spark, monkeypatch):
    """Texts that share several buckets meet in one of them, split or not, and no pair of different classes is left out."""
    rng, rows = random.Random(9), []
    base = [f"w{i}" for i in range(120)]
    for i in range(24):
        near = list(base[:100 + i % 8])
        for at in rng.sample(range(len(near)), 6):
            near[at] = f"n{i}x{at}"
        rows.append((i, " ".join(near)))
    made = N.sketched(spark.createDataFrame(rows, "doc_id long, text string")).withColumnRenamed("doc_id", "id").cache()
    buckets = made.selectExpr("id", "explode(sketches) AS bucket").withColumn("component", N.F.expr("id % 20"))
    meet = {}
    for r in buckets.collect():
        meet.setdefault(r.bucket, set()).add(r.id)
    shared = {(a, b) for ids in meet.values() for a in ids for b in ids if a < b and a % 20 != b % 20}
    passed = {(r.a, r.b) for r in N.allowed(spark.createDataFrame(sorted(shared), "a long, b long"), made).collect()}
    monkeypatch.setattr(type(made), "distinct", lambda self: self)
    for hot in (1000, 3):
        monkeypatch.setattr(N, "HOT", hot)
        got = [(r.a, r.b) for r in N.cross_pairs(made, buckets).collect()]
        assert len(got) == len(set(got)) and set(got) == passed and len(passed) > 30
    assert sum(len(ids) > 2 for ids in meet.values()) > 20
