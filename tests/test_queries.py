"""Every registered query beside its SQL twin, over whole tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference, spark_result, sql_result

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SLOW = {"m4_m5_m6_m7_compare_models"}
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    problem = difference(spark_result(QUERIES[name](spark, SF_DIR)), sql_result(con, ORACLES[name]))
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_query_without_sql_returns_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_flagship_returns_rows(spark):
    assert entry.entry(spark).count() > 0
