"""Every registered query against its SQL counterpart, values and types compared."""

from __future__ import annotations

import datetime
import decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from activity_mart.testbed import oracle, registry

# The optional operators are compared with SQL, or with brute force, in their own folder.
QUERIES, ORACLES = registry.QUERIES, oracle.oracle_sql()


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return ("double", float(f"{value:.12g}"))
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return (type(value).__name__, value)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.date):
        return ("date", value.isoformat())
    return ("int", int(value))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, sf_dir, database):
    found = QUERIES[name](spark, sf_dir)
    expected = database.sql(ORACLES[name])
    assert sorted(found.columns) == sorted(expected.columns)
    left, right = _rows(found.columns, found.collect()), _rows(expected.columns, expected.fetchall())
    assert left, "no rows"
    assert len(left) == len(right)
    differing = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
    assert not differing, f"{len(differing)} rows differ, first: {differing[0]}"
