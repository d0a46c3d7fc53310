"""Every query that has SQL against it on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import oracle  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

PATH = "/root/testdata/sf0.001"
WHOLE_WAREHOUSES = {"star_initial_counts", "star_incremental_counts"}  # see test_star_jobs.py


@pytest.fixture(scope="module")
def con():
    return oracle.connect(PATH)


@pytest.mark.parametrize("name", [n for n in oracle_sql() if n not in WHOLE_WAREHOUSES])
def test_query_agrees_with_sql(spark, con, name):
    assert oracle.differences(queries()[name](spark, PATH), con, oracle_sql()[name]) == []


def test_flagship(spark):
    assert entry(spark).count() > 0
