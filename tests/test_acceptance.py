"""Every registered query against its SQL, run by DuckDB on the same tables."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter

import duckdb
import pytest

from quayside.plans import acceptance, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in acceptance.TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{SF_DIR}/{name}.parquet')"
        )
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(acceptance.queries()))
def test_matches_sql(spark, duck, name):
    found = acceptance.queries()[name](spark, SF_DIR)
    expected = duck.execute(oracle.oracle_sql()[name])
    columns = [item[0] for item in expected.description]
    assert sorted(found.columns) == sorted(columns)
    rows = expected.fetchall()
    assert rows
    assert _bag(found.columns, found.collect()) == _bag(columns, rows)


def test_every_query_has_sql():
    assert set(acceptance.queries()) == set(oracle.oracle_sql())
