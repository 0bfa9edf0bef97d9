from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidegate.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8,3]",  # a task may fail twice
        spark_sql_shuffle_partitions="4",
        spark_default_parallelism="4",
        spark_ui_enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf():
    return SF


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=repr)

    return collect
