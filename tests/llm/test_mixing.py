from __future__ import annotations

import collections

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.helpers import ODD, documents, empty, odd, prose
from transitlens.llm import mixing as M


def poured(sizes):
    """Targets by pouring out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        rest = total - sum(stopped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return stopped | share
        stopped |= {s: 2.0 * sizes[s] for s in over}


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "b", "ä", "z", "é", "😀", "￿", None]), st.integers(0, 1000), min_size=1))
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in M.targets(table).collect()}
    want = poured(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    assert got == pytest.approx(want)


def test_mix(spark):
    rows = [(i, prose(i, 5 + i * 7 % 90), None, "abcd"[i % 7 % 4]) for i in range(600)]
    docs = documents(spark, rows)
    first = M.mix(docs).collect()
    assert sorted(first) == sorted(M.mix(docs.repartition(3)).collect())  # reruns agree
    assert len(first) == 600 and all(r.taken == r.copies * r.size <= 2 * r.size for r in first)
    taken, most = collections.Counter(), collections.Counter()
    for r in first:
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
        assert int(2 * r.target / r.source_size) / 2 - 1 < r.copies < r.target / r.source_size + 1
    sizes = {r.source: r.source_size for r in first}
    for source, target in poured(sizes).items():
        assert abs(taken[source] - target) <= most[source]
    mixed = M.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert collections.Counter(r.doc_id for r in mixed.collect()) == {r.doc_id: r.copies for r in first if r.copies}


def test_identical_rows(spark):
    """300 equal rows: their copies come near the target as well, and each row takes its part."""
    rows = [(1, "one two three", None, "a")] * 300 + [(2, prose(3, 4000), None, "b")] * 2
    got = M.mix(documents(spark, rows)).collect()
    assert len(got) == 302
    one = [r for r in got if r.doc_id == 1]
    assert abs(sum(r.taken for r in one) - one[0].target) <= 3
    mixed = M.mixed_documents(documents(spark, rows)).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in mixed}[1] == sum(r.copies for r in one)


def test_odd_rows(spark):
    rows = M.mix(odd(spark)).collect()
    assert len(rows) == len(ODD)
    assert sorted(str((r.doc_id, r.size)) for r in rows) == sorted(str((i, len((t or "").split()))) for i, t, _, _ in ODD)
    assert all(r.copies == 0 for r in rows if not r["size"])


def test_empty_table(spark):
    assert M.mix(empty(spark)).count() == 0 and M.mixed_documents(empty(spark)).count() == 0
