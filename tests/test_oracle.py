"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, duck, name):
    rows, problem = compare(spark, duck, FOLDER, queries()[name], oracle_sql().get(name))
    assert problem is None
    if name not in oracle_sql():
        assert rows > 0


def test_entry(spark):
    assert entry(spark).columns == ["id", "score", "speaker", "h_text"]
