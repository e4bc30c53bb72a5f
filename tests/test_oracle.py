"""Every query against its SQL on a second engine, over whole tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from storeloom import catalog, oracle

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.QUERIES
SQL = oracle.SQL


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def by_name(names, rows):
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted(repr([row[at] for at in order]) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    answer = duck.execute(SQL[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == sorted(result.columns)
    expected = by_name(names, answer.fetchall())
    assert by_name(result.columns, [tuple(r) for r in result.collect()]) == expected
    assert expected


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["customer_name", "total_spending"]
