from __future__ import annotations

import corpus_pipeline
from llm.helpers import ODD, documents, empty, odd, prose


def test_stages(spark):
    """Junk goes, repeated lines and near copies go, and what is left is mixed and encoded."""
    rows = [(i, prose(i, 200), "en", "ab"[i % 2]) for i in range(40)]
    rows += [(100, "spam " * 300, "en", "a"), (101, prose(3, 200) + " end", "en", "a"), (102, "short", "en", "b")]
    docs = documents(spark, rows)
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "").cache()
        seen.append({r.doc_id: r for r in docs.collect()})
    assert 100 not in seen[0] and 102 not in seen[0] and set(range(40)) <= set(seen[0])
    assert set(seen[1]) == set(seen[0])
    assert len(seen[1][101].text) < 200 and all(r.n_chars == len(r.text) for r in seen[1].values())
    assert set(range(40)) <= set(seen[2])
    assert 101 not in seen[3] or seen[1][101].text
    assert all(r.n_tokens == len(r.ids) > 0 for r in seen[4].values())


def test_odd_rows(spark):
    for docs in (odd(spark), empty(spark)):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.columns == columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() <= len(ODD) * 2
