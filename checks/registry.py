from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None, as_text: str = ""):
    """Registers a query under its function name, with its SQL where it has one.

    The columns named in ``as_text`` (dates, integers that may be missing) are shown as text on
    both sides, since the two engines hand them to Python in different types.
    """
    shown = as_text.split()

    def add(fn):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            df = fn(spark, sf)
            return df.selectExpr(
                *[f"CAST({c} AS STRING) AS {c}" if c in shown else c for c in df.columns]
            )

        QUERIES[key] = run if shown else fn
        if sql is not None:
            texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in shown)
            ORACLES[key] = f"SELECT * REPLACE ({texts}) FROM (\n{sql}\n) q" if shown else sql
        return fn

    return add
