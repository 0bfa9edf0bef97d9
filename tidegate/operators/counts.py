"""Source counts and size profiles. Every aggregate is merged map-side before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.clean import clean_counts
from tidegate.functions.dates import trunc_day, trunc_hour
from tidegate.operators.slices import CREATED, UPDATED, owner_filter, through_day
from tidegate.sources.landing import CSV_OPTIONS



def record_counts(df: DataFrame, updated: str = UPDATED) -> DataFrame:
    """Rows, earliest and latest update, in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(updated).alias("min_update_date"),
        F.max(updated).alias("max_update_date"),
    )


def record_counts_no_lud(df: DataFrame, owner: str | None = None) -> DataFrame:
    """Rows of a table without an update date; metadata tables count one owner only."""
    if owner is not None:
        df = owner_filter(df, owner)
    none = F.lit(None).cast("timestamp_ntz")
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", none.alias("min_update_date"), none.alias("max_update_date")
    )


def record_counts_cdc(
    df: DataFrame, as_of: date, lag: int = 1, updated: str = UPDATED, created: str = CREATED
) -> DataFrame:
    """Counts through the day ``lag`` days before ``as_of``."""
    return record_counts(through_day(df, as_of, lag, updated, created), updated)


def counts_or_default(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Text counts as numbers and stamps; a missing or unreadable count is 0 without dates.

    ``counts`` has text columns ``row_count``, ``min_update_date``, ``max_update_date``; no row at
    all gives the default row too.
    """
    names = ("row_count", "min_update_date", "max_update_date")
    clean = clean_counts(counts, names)
    number = F.col("row_count").try_cast("bigint")
    stamp = {n: F.when(number.isNotNull(), F.col(n)) for n in names[1:]}
    return clean.groupBy(*by).agg(
        F.coalesce(F.max(number), F.lit(0).cast("bigint")).alias("row_count"),
        *[F.max(stamp[n]).alias(n) for n in names[1:]],
    )


def csv_bytes(df: DataFrame) -> Column:
    """Size of a row in a staged file, its line end included."""
    text = [F.col(f"`{name}`").cast("string").alias(name) for name in df.columns]
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    return F.octet_length(F.to_csv(F.struct(*text), options)) + 1


def day_profile(df: DataFrame, updated: str = UPDATED, with_bytes: bool = False) -> DataFrame:
    """Rows per update day (and staged bytes, which reads every column). Unordered."""
    costs = [F.sum(csv_bytes(df)).alias("byte_count")] if with_bytes else []
    return (
        df.filter(F.col(updated).isNotNull())
        .groupBy(trunc_day(updated).alias("day"))
        .agg(F.count(F.lit(1)).alias("row_count"), *costs)
    )


def measure_days(df: DataFrame, updated: str = UPDATED, with_bytes: bool = False) -> DataFrame:
    """The day profile with each day's first and last update, rows without a date included.

    It holds the source counts as well (``profile_counts``), so that one pass over the table
    serves both.
    """
    costs = [F.sum(csv_bytes(df)).alias("byte_count")] if with_bytes else []
    return df.groupBy(trunc_day(updated).alias("day")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(updated).alias("first_update"),
        F.max(updated).alias("last_update"),
        *costs,
    )


def profile_counts(measured: DataFrame) -> DataFrame:
    """What ``record_counts`` gives, from ``measure_days``."""
    return measured.agg(
        F.coalesce(F.sum("row_count"), F.lit(0).cast("bigint")).alias("row_count"),
        F.min("first_update").alias("min_update_date"),
        F.max("last_update").alias("max_update_date"),
    )


def order_profile(profile: DataFrame, by: str = "day") -> DataFrame:
    return profile.orderBy(by)


def hour_profile(df: DataFrame, day: date | None = None, updated: str = UPDATED) -> DataFrame:
    """Rows per hour, of one day or of all."""
    if day is not None:
        df = df.filter(trunc_day(updated) == F.lit(day))
    return (
        df.filter(F.col(updated).isNotNull())
        .groupBy(trunc_hour(updated).alias("hour"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def extract_row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def undated_rows(df: DataFrame, updated: str = UPDATED) -> DataFrame:
    """Rows no date window can ever load; they keep a windowed load from matching its count."""
    return df.agg(F.count_if(F.col(updated).isNull()).alias("undated_rows"))


