"""Keyed matches of staged rows and target rows, key catalogs, and window assignment.

No join carries a broadcast hint. Small sides are read from files or built from the calendar, so
the optimizer knows their size and broadcasts them only below its threshold; beyond it the same
plans run as shuffled joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.dates import trunc_day
from tidegate.operators.slices import date_range


def parse_keys(primary_key: str) -> list[str]:
    """Key columns of a control row: one name, or several separated by commas."""
    keys = [part.strip() for part in primary_key.split(",") if part.strip()]
    if not keys:
        raise ValueError("no primary key given")
    return keys


def primary_keys(constraints: DataFrame, cons_columns: DataFrame, owner: str) -> DataFrame:
    """Key columns of every table of one owner."""
    cons = constraints.filter((F.col("owner") == owner) & (F.col("constraint_type") == "P"))
    cols = cons_columns.filter(F.col("owner") == owner)
    return (
        cons.select("constraint_name", "owner", "status")
        .join(
            cols.select("constraint_name", "owner", "table_name", "column_name", "position"),
            ["constraint_name", "owner"],
        )
        .select("table_name", "column_name", "position", "status", "owner")
    )


def _key_side(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select([F.col(f"`{k}`").alias(f"_key_{k}") for k in keys])


def _on(keys: Sequence[str]) -> Column:
    """Null-safe, so that loading the same stage twice changes nothing."""
    pairs = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_key_{k}`")) for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    return left.join(_key_side(right, keys), _on(keys), how)


def rows_without_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _match(left, right, keys, "left_anti")


def rows_with_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _match(left, right, keys, "left_semi")


def keep_latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per key: the greatest by ``order_by``, then by all columns.

    A maximum over structs is merged before the shuffle, so a key that holds a large share of the
    rows reaches the final task as one row per input partition.
    """
    rank = [F.col(c) if isinstance(c, str) else c for c in order_by]
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    best = df.groupBy(*[F.col(f"`{k}`").alias(f"_key_{k}") for k in keys]).agg(
        F.max(F.struct(*[c.alias(f"_r{i}") for i, c in enumerate(rank)], whole.alias("row"))).alias(
            "best"
        )
    )
    return best.select("best.row.*")


def tag_staged(staged: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows with ``action``: ``update`` where the target has the key, else ``insert``.

    The target is first reduced to the staged keys, reading only its key columns.
    """
    hits = rows_with_match(target.select(*keys), staged, keys).distinct()
    hits = _key_side(hits, keys).withColumn("_hit", F.lit(True))
    return staged.join(hits, _on(keys), "left").select(
        *staged.columns,
        F.when(F.col("_hit"), "update").otherwise("insert").alias("action"),
    )


def upsert_rows(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a staged version, and all staged rows."""
    return rows_without_match(target, staged, keys).unionByName(staged)


def assign_window(
    df: DataFrame,
    windows: DataFrame,
    updated: str = "last_update_date",
    span: tuple[date, date] | None = None,
    remainder: bool = False,
) -> DataFrame:
    """Attaches ``window_id`` to each row in one pass; rows outside all windows drop out.

    Windows become their days, so the match is an equality on the day and not a range join. The
    number of days is bounded by the calendar span, not by the rows. Where windows have a
    ``begin_at`` (``split_days``), a day's windows come as one list, and the last one that has
    begun takes the row. ``span``, the first and last day of all windows where they are known, is
    pushed to the scan. With ``remainder`` no row drops out: those without a date are in the
    window ``undated``, other ones beyond all windows in ``outside``.
    """
    if span is not None and not remainder:
        df = date_range(df, *span, updated)
    days = windows.withColumn("_day", F.explode(F.sequence("begin_date", "end_date")))
    if "begin_at" in windows.columns:
        parts = F.struct(F.col("begin_at").alias("at"), F.col("window_id").alias("id"))
        days = days.groupBy("_day").agg(F.array_sort(F.collect_list(parts)).alias("_parts"))
        at = F.col(updated).cast("timestamp_ntz")
        begun = F.filter("_parts", lambda p: p["at"].isNull() | (p["at"] <= at))
        own = F.get(begun, F.size(begun) - 1)["id"]
    else:
        days, own = days.select(F.col("window_id").alias("_id"), "_day"), F.col("_id")
    joined = df.join(days, trunc_day(updated) == F.col("_day"), "left" if remainder else "inner")
    if remainder:
        rest = F.when(F.col(updated).isNull(), "undated").otherwise("outside")
        own = F.coalesce(own, rest)
    return joined.select(*df.columns, own.alias("window_id"))


def union_windows(*extracts: DataFrame) -> DataFrame:
    """Bag union of window extracts, by column name."""
    return reduce(lambda a, b: a.unionByName(b), extracts)
