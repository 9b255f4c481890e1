"""Every registered query against its SQL oracle, and the shape of the contract."""

import pytest

import __spark_entry__ as contract
from check import differences, oracle_frame
from creditmill.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() == 83


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_oracle(spark, name):
    found = contract.queries()[name](spark, SF).toPandas()
    assert differences(found, oracle_frame(contract.oracle_sql()[name], SF)) is None
