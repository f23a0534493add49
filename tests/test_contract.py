"""Every registered query against its SQL twin."""

import os

import pytest
from oracle import compare, connect

from gridspark.plans import PLANS

SF_DIR = os.environ.get("CONTRACT_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query_equals_sql(spark, duck, name):
    assert PLANS[name].sql, "every query has an SQL twin"
    assert compare(spark, duck, PLANS[name], PLANS[name].sql, SF_DIR) is None


def test_entry_runs(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(PLANS) <= set(oracle_sql()) <= set(queries())
