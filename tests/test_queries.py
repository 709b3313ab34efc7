"""Every named query against its SQL, over whole tables."""

import oracle
import pytest

import __spark_entry__ as contract
from flatloom.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, sf_dir, con, name):
    found = oracle.differences(contract.queries()[name](spark, sf_dir), con, contract.oracle_sql()[name])
    assert found == []


def test_entry(spark):
    assert contract.entry(spark).count() == 10


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())
