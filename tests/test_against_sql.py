"""Every query gives what the second engine gives for its SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}
QUERIES = {name: contract.queries()[name] for name in contract.catalog.QUERIES}
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{contract.SMOKE_DIR}/{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, engine, name):
    df = QUERIES[name](spark, contract.SMOKE_DIR)
    result = engine.execute(SQL[name])
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    assert sorted(df.columns) == sorted(names)
    assert {f.name: SPARK_TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    columns = sorted(names)
    ours = sorted(tuple(canonical(row[c]) for c in columns) for row in df.collect())
    theirs = sorted(
        tuple(canonical(row[names.index(c)]) for c in columns) for row in result.fetchall()
    )
    assert ours == theirs


def test_entry_gives_one_row_per_customer(spark):
    matrix = contract.entry(spark)
    assert matrix.count() == matrix.select("customer_id").distinct().count() > 0
