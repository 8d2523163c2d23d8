"""Every registered query against its DuckDB statement, value for value."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from ebbtide.plans.oracle import oracle_statements
from ebbtide.plans.registry import all_queries

TABLES = ("events", "labels")
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
    "float": "FLOAT", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "date": "DATE",
}


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_statements()))
def test_query_equals_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = db.sql(oracle_statements()[name])
    actual = all_queries()[name](spark, sf_dir)
    types = {f.name: TYPES[f.dataType.simpleString()] for f in actual.schema.fields}
    assert types == {c: str(t) for c, t in zip(expected.columns, expected.types)}
    got, want = rows_of(actual.columns, actual.collect()), rows_of(expected.columns, expected.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_every_statement_has_a_query():
    assert set(oracle_statements()) <= set(all_queries())
    assert set(all_queries()) - set(oracle_statements()) == {
        "compare_classifiers", "compare_mlp", "score_users",
    }


def test_entry(spark):
    assert contract.entry(spark).count() > 0
