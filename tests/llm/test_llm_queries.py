"""The queries that SQL can express, against their SQL."""

from pathlib import Path

import duckdb
import pytest

from telemill.llm.oracle import ORACLE
from telemill.llm.queries import QUERIES
from tests.test_queries import rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    expected = connection.execute(ORACLE[name])
    names = [column[0] for column in expected.description]
    found = QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(names)
    assert rows_of(found.columns, [tuple(row) for row in found.collect()]) == rows_of(names, expected.fetchall())
