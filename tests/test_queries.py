"""Every query against its SQL on the given tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from telemill.checks.oracle import ORACLE
from telemill.checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(x):
        return round(x, 9) if isinstance(x, float) and math.isfinite(x) else x

    return Counter(tuple(value(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    expected = database.execute(ORACLE[name])
    expected_names = [column[0] for column in expected.description]
    expected_rows = rows_of(expected_names, expected.fetchall())
    found = QUERIES[name](spark, FOLDER)
    found_rows = rows_of(found.columns, [tuple(row) for row in found.collect()])
    assert sorted(found.columns) == sorted(expected_names)
    assert sum(expected_rows.values()) > 0
    assert found_rows == expected_rows
