"""Every registered query agrees with its SQL twin, values and types."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as contract
from siltgate_queries.oracle import ORACLE
from siltgate_queries.registry import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    sql = contract.oracle_sql()[name]
    assert compare.spark_rows(df) == compare.sql_rows(con, sql)
    types = {f.name: SQL_TYPES.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert types == compare.kinds(con, sql)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
