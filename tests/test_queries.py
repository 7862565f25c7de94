"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from feedlens.plans import catalog
from tools.check_queries import compare, connect


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, duck, small, name):
    problem, _, _, _ = compare(spark, duck, small, name)
    assert problem is None, problem


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() == 10
    assert result.columns == ["category_id", "events_count", "unique_users_count", "score", "category_name"]


def test_oracles_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
