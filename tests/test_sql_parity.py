"""Every query with an SQL counterpart gives the same rows in both engines."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry_point

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, small, con, name):
    assert compare.differences(QUERIES[name](spark, small), con, ORACLES[name]) == []


def test_comparison_sees_a_difference(spark, small, con):
    sql = ORACLES["time_extent"].replace("+ 1", "+ 2")
    assert compare.differences(QUERIES["time_extent"](spark, small), con, sql)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
