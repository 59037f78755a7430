"""Every registered query against its SQL, and all of them registered."""

from __future__ import annotations

import datetime
import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.plans.oracle import ORACLE_SQL
from tidemark.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, database):
    got = contract.queries()[name](spark, SF_DIR)
    expected = database.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, got.collect()) == _rows(columns, expected.fetchall())


def test_flagship_runs(spark):
    assert contract.entry(spark).count() > 0
