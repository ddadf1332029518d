"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from reviewflow.plans.oracle import ORACLE
from reviewflow.plans.queries import QUERIES

import __spark_entry__ as contract


def comparable(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(round(value, 9))
    return "null" if value is None else str(value)


def as_multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(comparable(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck(tables):
    connection = duckdb.connect()
    for file in Path(tables).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, tables, name):
    actual = QUERIES[name](spark, tables)
    rows = actual.collect()
    expected = duck.execute(ORACLE[name])
    expected_columns = [column[0] for column in expected.description]
    expected_rows = expected.fetchall()
    assert sorted(actual.columns) == sorted(expected_columns)
    assert rows
    assert as_multiset(actual.columns, rows) == as_multiset(expected_columns, expected_rows)


def test_entry(spark):
    counts = contract.entry(spark)
    assert counts.columns == ["word", "ct"]
    assert counts.count() > 0
