from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest

from llm.helpers import ODD, documents, empty, odd, prose
from transitlens.llm import toxicity as X


def labels(spark, rows):
    return spark.createDataFrame([(i, None, t) for i, t in rows], "doc_id long, quality int, toxic int")


def corpus(n=600):
    rng, rows, truth = random.Random(4), [], {}
    for i in range(n):
        words = prose(i, 80).split()
        truth[i] = int(i % 6 == 0)
        if truth[i]:
            for w in rng.sample(["vile", "brute", "filth", "wretch"], 3):
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words), "en", "a"))
    return rows, truth


def test_held_out_accuracy(spark):
    """A third of the documents is labelled; held-out ones are told apart all the same."""
    rows, truth = corpus()
    known = [(i, t) for i, t in truth.items() if i // 6 % 3 == 0]
    got = X.toxicity(documents(spark, rows), labels(spark, known)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    out = [r for r in got if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in out]) > 0.95
    assert [r for r in out if truth[r.doc_id]]


def test_held_out_labels_are_not_read(spark):
    rows, truth = corpus(300)
    held = {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    flipped = [(i, 1 - t if i in held else t) for i, t in truth.items()]
    a = X.toxicity(documents(spark, rows), labels(spark, list(truth.items())))
    b = X.toxicity(documents(spark, rows), labels(spark, flipped))
    assert sorted(a.collect()) == sorted(b.collect())


def test_risk_is_not_negative():
    """With few toxic examples, all of which are in the unlabelled text too, training ends with finite weights."""
    rows = [np.array([1, 2]), np.array([1, 3])]
    weights, bias = X.train(rows, rows + [np.array([4, 5])] * 20, 0.1, steps=200)
    assert np.isfinite(weights).all() and np.isfinite(bias)


def test_odd_rows(spark):
    for known in ([(1, 1), (4, None), (4, 0), (4, 1), (None, 1)], [], [(5, 0)]):
        got = X.toxicity(odd(spark), labels(spark, known)).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert X.toxicity(empty(spark), labels(spark, [(1, 1)])).count() == 0


@pytest.mark.parametrize("prior", [0.02, 0.3, 0.9])
def test_first_step_goes_down_the_risk(prior):
    """The first Adam step moves every weight against the slope of the risk, written out document by document."""
    rng = np.random.default_rng(7)
    positive = [np.unique(rng.integers(0, 12, 6)) for _ in range(200)]
    unlabelled = [np.unique(rng.integers(6, 30, 9)) for _ in range(400)]
    rate = 0.05
    weights, _ = X.train(positive, unlabelled, prior, steps=1, batch=400, rate=rate, decay=0.0, seed=2)
    draw = np.random.default_rng(2)
    draw.permutation(len(unlabelled))
    drawn = [positive[i] for i in draw.integers(0, len(positive), 400)]
    start = math.log(prior / (1 - prior))

    def loss(z):
        return math.log1p(math.exp(-z))

    def risks(feature, change):
        g = lambda doc: start + (change if feature in doc else 0.0)
        toxic = prior * sum(loss(g(d)) for d in drawn) / len(drawn)
        rest = sum(loss(-g(d)) for d in unlabelled) / len(unlabelled) - prior * sum(loss(-g(d)) for d in drawn) / len(drawn)
        return toxic, rest

    moved = np.flatnonzero(weights)
    assert len(moved) > 10
    for f in moved:
        (up_t, up_r), (down_t, down_r) = risks(f, 1e-5), risks(f, -1e-5)
        slope = (up_t - down_t + up_r - down_r) / 2e-5
        assert abs(slope) > 1e-9 and weights[f] == pytest.approx(-rate * np.sign(slope), rel=1e-3)
