"""Every registered query against its SQL, on the smallest sample."""

import datetime as dt
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from catalogue.queries import QUERIES as NAMED

SF = Path("/root/testdata/sf0.001")
# The text operators have tests of their own.
QUERIES = {name: query for name, query in entry_point.queries().items() if name in NAMED}
ORACLE = {name: sql for name, sql in entry_point.oracle_sql().items() if name in NAMED}

pytestmark = pytest.mark.skipif(not SF.exists(), reason="sample tables not present")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    return value.replace(tzinfo=None) if isinstance(value, dt.datetime) else value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) == set(NAMED)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    frame = QUERIES[name](spark, str(SF))
    columns = sorted(frame.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    result = tables.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in order) for r in result.fetchall()), key=repr)
    assert got == expected


def test_entry(spark):
    assert entry_point.entry(spark).count() == 84
