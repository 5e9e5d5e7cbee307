"""Every query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as contract
from compare import database, difference
from conftest import SMALL
from logweir.catalogue.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(contract.queries()[name](spark, SMALL), con, contract.oracle_sql()[name]) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())
    assert contract.entry(spark).count() > 0
