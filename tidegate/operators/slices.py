"""Row slices of a source table. All are plain filters that reach the scan."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.dates import trunc_day, upper
from tidegate.sources.tables import scan_projected

UPDATED, CREATED = "last_update_date", "creation_date"


def cdc_day_slice(
    df: DataFrame,
    as_of: date,
    lag: int = 1,
    since: date | None = None,
    updated: str = UPDATED,
    created: str = CREATED,
) -> DataFrame:
    """Rows updated or created on the day ``lag`` days before ``as_of``.

    ``since`` widens the slice back to that day, to catch up on missed runs.
    """
    last = as_of - timedelta(days=lag)
    first = min(since, last) if since else last
    return df.filter(
        trunc_day(updated).between(F.lit(first), F.lit(last))
        | trunc_day(created).between(F.lit(first), F.lit(last))
    )


def special_cdc_slice(
    df: DataFrame,
    return_fields: str,
    as_of: date,
    lag: int = 1,
    since: date | None = None,
    updated: str = UPDATED,
    created: str = CREATED,
) -> DataFrame:
    """The change slice with a stored select list."""
    return scan_projected(cdc_day_slice(df, as_of, lag, since, updated, created), return_fields)


def through_day(
    df: DataFrame, as_of: date, lag: int = 1, updated: str = UPDATED, created: str = CREATED
) -> DataFrame:
    """Rows updated or created on or before the day ``lag`` days before ``as_of``."""
    last = F.lit(as_of - timedelta(days=lag))
    return df.filter((trunc_day(updated) <= last) | (trunc_day(created) <= last))


def date_range(df: DataFrame, begin: date, end: date, updated: str = UPDATED) -> DataFrame:
    """Rows updated from ``begin`` to ``end``, both included; rows without a date never match."""
    return df.filter(trunc_day(updated).between(F.lit(begin), F.lit(end)))


def _in_slice(part: int, data_type: Column, text_type: str) -> Column:
    return data_type == text_type if part == 0 else data_type != text_type


def catalog_slice(
    columns: DataFrame,
    owner: str,
    part: int | None = None,
    text_type: str = "VARCHAR2",
) -> DataFrame:
    """Catalog rows of one owner with upper-case table names.

    Part 0 holds the text columns, part 1 the others; columns without a type are in neither.
    With ``part=None`` one pass returns both, marked in ``slice``.
    """
    named = (F.col("owner") == owner) & (F.col("table_name") == upper("table_name"))
    kind = F.col("data_type")
    if part is not None:
        return columns.filter(named & _in_slice(part, kind, text_type))
    return columns.filter(named & kind.isNotNull()).withColumn(
        "slice", F.when(_in_slice(0, kind, text_type), 0).otherwise(1)
    )


def owner_filter(df: DataFrame, owner: str) -> DataFrame:
    return df.filter(F.col("owner") == owner)
