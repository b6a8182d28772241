"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import duckdb_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(contract.audit_queries()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(contract.audit_queries()))
def test_query(spark, name):
    result = spark_rows(contract.queries()[name](spark, SF_DIR))
    assert result == duckdb_rows(contract.oracle_sql()[name], SF_DIR)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
