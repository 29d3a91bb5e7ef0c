import os

import pytest

import __spark_entry__ as contract
from tests.compare import (
    oracle_connection,
    oracle_rows,
    oracle_types,
    spark_rows,
    spark_types,
)

from workload.oracle import ORACLE_SQL
from workload.queries import REGISTERED

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_its_sql():
    assert set(REGISTERED) == set(ORACLE_SQL)
    assert set(ORACLE_SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_equals_sql(spark, connection, name):
    sql = contract.oracle_sql()[name]
    expected = oracle_rows(connection, sql)
    result = contract.queries()[name](spark, SF_DIR)
    actual = spark_rows(result)
    assert spark_types(result) == oracle_types(connection, sql)
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1])
    assert actual[1] == expected[1]
