"""Every registered query against its SQL twin in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from shelfmark.plans import ORACLE, QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(entry.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in result.description}
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    expected = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)
    assert got == expected
