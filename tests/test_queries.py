"""Every registered query against its DuckDB answer."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, open_tables
from checks.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_agrees_with_duckdb(spark, tables, name):
    rows, problem = compare(spark, tables, SF, queries()[name], oracle_sql()[name])
    assert problem is None
    assert rows > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == [
        "src_partition", "batch_id", "n", "good", "bad", "bytes", "earliest", "e2e_latency_ms",
    ]
