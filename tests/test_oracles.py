"""Every registered query agrees with its DuckDB oracle (sf0.001 here; the
driver and ``tests/oracle_check.py`` run the same check at sf0.01)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare, duck_connection
from transitlens.plans.oracles import ORACLES
from transitlens.plans.registry import QUERIES



@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    result = compare(spark, key, QUERIES[key], ORACLES[key], SF_SMALL, con)
    assert result["ok"], result


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert df.count() >= 0
    assert df.columns


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "route", "direction", "window_type",
                          "vehicle_count", "active_vehicles", "avg_speed", "avg_delay",
                          "min_delay", "max_delay"]


def test_queries_are_registered():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
    assert set(QUERIES) == set(ORACLES)
