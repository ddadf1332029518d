"""The registered queries against their SQL on the small tables, and what they may not do."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from reviewflow.llm.oracle import ORACLE
from reviewflow.llm.queries import QUERIES


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


def test_one_query_each():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, tables, name):
    actual = QUERIES[name](spark, tables)
    expected = duck.execute(ORACLE[name])
    columns = [column[0] for column in expected.description]
    assert sorted(actual.columns) == sorted(columns)
    assert as_multiset(actual.columns, actual.collect()) == as_multiset(columns, expected.fetchall())
