"""Every registered query that has SQL gives what DuckDB gives."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from samewise.plans import oracles, queries

SF = Path("/root/testdata/sf0.001")
SQL = oracles.oracle_sql()
pytestmark = pytest.mark.skipif(not SF.exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.sql(f"create view {path.stem} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    frame = queries.queries()[name](spark, str(SF))
    found = duck.sql(SQL[name])
    assert sorted(frame.columns) == sorted(found.columns)
    assert table(frame.columns, frame.collect()) == table(found.columns, found.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.PLANS) - set(SQL)))
def test_other_queries_run(spark, name):
    assert queries.queries()[name](spark, str(SF)).columns


def test_entry(spark):
    assert entry.entry(spark).columns == ["s1", "cid"]
    assert set(SQL) <= set(entry.queries())
