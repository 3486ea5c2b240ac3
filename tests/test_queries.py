"""Every registered query next to its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from fleetlens.plans.registry import REGISTERED
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_equals_sql(spark, con, name):
    assert name in entry_point.oracle_sql()
    df = entry_point.queries()[name](spark, SF)
    assert compare(df, con, entry_point.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
