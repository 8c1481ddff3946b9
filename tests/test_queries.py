"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import difference, tables_of
from tidelog.plans import oracles
from tidelog.plans import queries as plans

SF_DIR = "/root/testdata/sf0.001"
SQL_TYPES = {
    "boolean": "BOOLEAN",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def sql_tables():
    return tables_of(SF_DIR)


def test_every_query_has_sql():
    assert set(plans.registered()) == set(oracles.statements())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(plans.registered()))
def test_query_matches_sql(spark, sql_tables, name):
    sql = entry.oracle_sql()[name]
    result = entry.queries()[name](spark, SF_DIR)
    types = {row[0]: row[1] for row in sql_tables.execute(f"DESCRIBE {sql}").fetchall()}
    assert {column: SQL_TYPES[type_] for column, type_ in result.dtypes} == types
    assert difference(result.toPandas(), sql_tables.execute(sql).df()) is None


def test_entry_is_the_flagship(spark):
    result = entry.entry(spark)
    assert result.columns == ["value", "count"]
    assert result.count() > 0
