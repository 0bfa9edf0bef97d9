"""Every registered query against its SQL."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks import QUERIES
from compare import TABLES, compare
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    """Apart from the training-data queries, some of which SQL cannot express."""
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(oracle_sql()) == set()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    verdict, _ = compare(spark, con, SF, name, queries()[name], oracle_sql().get(name))
    assert verdict.startswith("same"), verdict


def test_entry_gives_the_tally(spark):
    row = entry(spark).first()
    assert row.inserted_rows + row.updated_rows == row.processed
    assert row.rows_after == row.rows_before + row.inserted_rows
