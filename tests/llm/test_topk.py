from __future__ import annotations

import math

import numpy as np

from transitlens.llm.topk_search import top_k


def brute(rows, k, every):
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, label int, score int")


def test_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.2, 64).astype(np.float32).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(40)]  # ties
    rows += [(i, rng.normal(0, 1, 20).astype(np.float32).tolist()) for i in range(440, 520)]
    got = top_k(table(spark, rows).repartition(5), 10, 20)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10, 20)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (100, None), (200, []), (1, [None, 1.0]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (4, [3.0]), (5, [-1.0, 0.5]), (300, [2.0]), (6, [1.0, 2.0])]
    assert sorted(map(tuple, top_k(table(spark, rows)).collect())) == brute(rows, 10, 100)
    assert top_k(table(spark, [])).count() == 0
    assert top_k(table(spark, [(1, [1.0])])).count() == 0


def test_rows_of_one_id_get_a_list_each(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.3, 8).astype(np.float32).tolist()) for i in range(90)]
    rows += [(20, rng.normal(0, 0.3, 8).astype(np.float32).tolist()), (40, rows[40][1])]  # another vector, the same row
    got = top_k(table(spark, rows).repartition(3), 10, 20)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    want = brute(rows, 10, 20)
    assert sorted(map(tuple, got.collect())) == want and len(want) == 7 * 10
