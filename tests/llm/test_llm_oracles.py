"""Queries with SQL against DuckDB, and that all queries run on whole tables."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from oracle_check import compare, duck_connection
from transitlens.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, key):
    result = compare(spark, key, QUERIES[key], ORACLES[key], SF_SMALL, duck_connection(SF_SMALL))
    assert result["ok"], result


def test_all_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
