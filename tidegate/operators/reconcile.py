"""Reconciliation and state: column expressions over run results, and keyed merges of them.

Control and statistics tables hold one row per table or file, so the merges are joins of frames
far smaller than the data they describe.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.operators.selection import (
    CHANGE_TYPES,
    apply_run_args,
    order_work,
    select_snapshot,
)
from tidegate.schemas import CONTROL
from tidegate.sources.landing import CSV_OPTIONS

# Statuses of a file, and the moves from full to change loading.
IN_PROGRESS, SUCCESS, FAILED, NO_ROWS = (
    "In Progress",
    "Success",
    "Failed",
    "Success - No rows returned",
)
UNDATED, OUTSIDE = "undated", "outside"  # windows of the rows that no date window covers
PROMOTIONS = {"Full": "CDC", "Special_Full": "Special_CDC"}

ZERO_ROW_FIELDS = ("last_update_date", "zero_rows")
RESULT_FIELDS = (
    "last_update_date",
    "source_row_count",
    "target_row_count",
    "extract_error",
    "counted_at",
    "min_update_date",
    "max_update_date",
    "created",
    "load_type",
    "zero_rows",
    "load_error",
    "load_error_message",
    "inserted_rows",
    "updated_rows",
)


def load_tally(results: DataFrame) -> DataFrame:
    """Inserted and updated rows of each load, from the counts around it."""
    change = F.col("load_type").isin(*CHANGE_TYPES)
    grown = F.col("rows_after") - F.col("rows_before")
    return results.withColumns(
        {
            "inserted_rows": F.when(change, grown).otherwise(F.col("rows_after")),
            "updated_rows": F.when(change, F.col("processed") - grown).otherwise(
                F.lit(0).cast("bigint")
            ),
        }
    )


def count_difference(results: DataFrame) -> DataFrame:
    return results.withColumn("count_difference", F.col("source_count") - F.col("rows_after"))


def next_load_type(
    results: DataFrame, ignore_flag: bool = False, types: Sequence[str] = tuple(PROMOTIONS)
) -> DataFrame:
    """Full loads whose counts agree move on to change loading.

    A failed load never does, nor one whose source could not be counted: its 0 agrees with nothing, nor
    one whose rows were compared and differ.
    """
    agree = (F.col("source_count") == F.col("rows_after")) & ~F.coalesce(
        F.col("load_error"), F.lit(False)
    )
    if "count_failed" in results.columns:
        agree = agree & ~F.coalesce("count_failed", F.lit(False))
    if "content_differs" in results.columns:
        agree = agree & ~F.coalesce("content_differs", F.lit(False))
    if not ignore_flag:
        agree = agree & F.col("promote")
    moved = F.col("load_type")
    for before in types:
        moved = F.when(agree & (F.col("load_type") == before), PROMOTIONS[before]).otherwise(moved)
    return results.withColumn("next_load_type", moved)


def next_load_type_subbatch(results: DataFrame) -> DataFrame:
    """The rule inside split windows: agreement alone decides between change and full."""
    agree = F.col("source_count") == F.col("rows_after")
    return results.withColumn("next_load_type", F.when(agree, "CDC").otherwise("Full"))


def advance_watermark(results: DataFrame) -> DataFrame:
    """The finish time on success; a failed load keeps the earlier stamp, so it runs again."""
    failed = F.coalesce(F.col("load_error"), F.lit(False))
    return results.withColumn(
        "next_update_date",
        F.when(failed, F.col("prior_update_date")).otherwise(F.col("finished_at")),
    )


def merge_by_key(
    base: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """``base`` with ``columns`` replaced, NULLs included, where ``updates`` has the key."""
    side = updates.selectExpr(
        f"{key} AS _key", "true AS _hit", *[f"{c} AS _new_{c}" for c in columns]
    )
    kinds = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    joined = base.join(side, F.col(key) == F.col("_key"), "left")
    return joined.selectExpr(
        *[
            f"CAST(CASE WHEN _hit THEN _new_{c} ELSE {c} END AS {kinds[c]}) AS {c}"
            if c in columns
            else c
            for c in base.columns
        ]
    )


def settle(results: DataFrame, ignore_flag: bool = False) -> DataFrame:
    """All derived columns of a run result."""
    return advance_watermark(
        next_load_type(count_difference(load_tally(results)), ignore_flag=ignore_flag)
    )


def _written(results: DataFrame) -> DataFrame:
    """Settled results under the control table's field names."""
    return results.select(
        "table_uid",
        F.col("next_update_date").alias("last_update_date"),
        F.col("source_count").alias("source_row_count"),
        F.col("rows_after").alias("target_row_count"),
        F.coalesce("extract_error", F.lit("")).alias("extract_error"),
        F.col("finished_at").alias("counted_at"),
        "min_update_date",
        "max_update_date",
        F.lit(True).alias("created"),
        F.col("next_load_type").alias("load_type"),
        F.lit(False).alias("zero_rows"),
        "load_error",
        F.coalesce("load_error_message", F.lit("")).alias("load_error_message"),
        "inserted_rows",
        "updated_rows",
    )


def apply_success(control: DataFrame, settled: DataFrame) -> DataFrame:
    """The 14 result fields of loaded tables."""
    return merge_by_key(control, _written(settled), "table_uid", RESULT_FIELDS)


def _zero_rows(results: DataFrame) -> DataFrame:
    return results.select(
        "table_uid",
        F.col("finished_at").alias("last_update_date"),
        F.lit(True).alias("zero_rows"),
    )


def apply_zero_rows(control: DataFrame, results: DataFrame) -> DataFrame:
    """An empty extract moves the stamp and sets the flag; nothing else changes."""
    return merge_by_key(control, _zero_rows(results), "table_uid", ZERO_ROW_FIELDS)


def _extract_failure(results: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return results.select(
        "table_uid",
        F.col("source_count").alias("source_row_count"),
        zero.alias("target_row_count"),
        "extract_error",
        F.col("finished_at").alias("counted_at"),
        "min_update_date",
        "max_update_date",
        F.lit(True).alias("created"),
        "load_type",
        F.lit(False).alias("zero_rows"),
        F.lit(False).alias("load_error"),
        F.lit("").alias("load_error_message"),
        zero.alias("inserted_rows"),
        zero.alias("updated_rows"),
    )


def apply_extract_failure(control: DataFrame, results: DataFrame) -> DataFrame:
    """Counts and message of a failed extract; the stamp stays, so the table runs again."""
    return merge_by_key(control, _extract_failure(results), "table_uid", RESULT_FIELDS[1:])


def _schedule_done(settled: DataFrame) -> DataFrame:
    return _written(settled).withColumns(
        {
            "load_error": F.lit(False),
            "load_error_message": F.lit(""),
            "inserted_rows": F.lit(None).cast("bigint"),
            "updated_rows": F.lit(None).cast("bigint"),
            "schedule": F.lit("false"),
        }
    )


def apply_schedule_done(control: DataFrame, settled: DataFrame) -> DataFrame:
    """Results of a scheduled load: the schedule is off, error and tally fields are blank.

    A failed load keeps its schedule and stamp and records the error.
    """
    failed = F.coalesce(F.col("load_error"), F.lit(False))
    good, bad = settled.filter(~failed), settled.filter(failed)
    done = _schedule_done(good)
    control = merge_by_key(control, done, "table_uid", (*RESULT_FIELDS, "schedule"))
    return apply_success(control, bad)


# control as a fold of facts ------------------------------------------------------------------


def as_facts(updates: DataFrame, fields: Sequence[str], at: Column, edited: bool) -> DataFrame:
    """``updates`` as facts: what each of ``fields`` is from ``at`` on."""
    shown = [
        (F.col(f.name) if f.name in updates.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in CONTROL.fields
    ]
    names = F.array(*[F.lit(name) for name in fields])
    return updates.select(*shown, names.alias("fields"), at.alias("at"), F.lit(edited).alias("edited"))


def result_facts(results: DataFrame) -> DataFrame:
    """What runs have found out, from their results as they were recorded."""
    loaded, scheduled = F.col("outcome") == "loaded", F.coalesce(F.col("scheduled"), F.lit(False))
    failed = F.coalesce(F.col("load_error"), F.lit(False))
    settled = settle(results.filter(loaded))
    empty = results.filter(F.col("outcome") == "empty")
    unread = results.filter(F.col("outcome") == "extract_failed")
    off = scheduled & ~failed
    kinds = [
        (settled.filter(~off), _written, RESULT_FIELDS),
        (settled.filter(off), _schedule_done, (*RESULT_FIELDS, "schedule")),
        (empty, _zero_rows, ZERO_ROW_FIELDS),
        (unread, _extract_failure, RESULT_FIELDS[1:]),
    ]
    facts = []
    for rows, updates, fields in kinds:
        stamped = updates(rows.withColumn("table_uid", F.struct("table_uid", "finished_at")))
        found = stamped.withColumns(
            {"table_uid": F.col("table_uid.table_uid"), "_at": F.col("table_uid.finished_at")}
        )
        facts.append(as_facts(found, fields, F.col("_at"), False))
    return reduce(DataFrame.unionByName, facts)


def fold_control(facts: DataFrame) -> DataFrame:
    """The control table: for each table and field the latest fact, of equally late ones an edit.

    The order in which facts arrive, and facts that arrive twice, make no difference. Tables that were
    never defined (no edit of their source) are left out.
    """
    whole = F.struct("at", "edited", F.hash(*CONTROL.fieldNames()).alias("any"))

    def latest(name: str) -> Column:
        when = F.when(F.array_contains("fields", name), whole)
        return F.max_by(F.col(name), when).alias(name)

    fields = [n for n in CONTROL.fieldNames() if n != "table_uid"]
    defined = F.max(F.col("edited") & F.array_contains("fields", "source_table"))
    return (
        facts.groupBy("table_uid")
        .agg(*[latest(n) for n in fields], defined.alias("_defined"))
        .where("_defined")
        .select(*CONTROL.fieldNames())
    )


def apply_batch_progress(control: DataFrame, settled: DataFrame) -> DataFrame:
    """The ten fields a windowed load writes; error and tally fields are left alone."""
    return merge_by_key(control, _written(settled), "table_uid", RESULT_FIELDS[:10])


def window_progress(assigned: DataFrame, windows: DataFrame, rows: str = "1") -> DataFrame:
    """Rows of each window and the target's total after it, windows in date order.

    ``assigned`` has one row per source row, or per day with its count in the column ``rows``.
    Rows are added up per window before the shuffle; the running total is over windows only, whose
    number the calendar bounds.
    """
    sizes = assigned.groupBy("window_id").agg(F.sum(F.expr(rows)).cast("bigint").alias("_n"))
    sized = windows.join(sizes, "window_id", "left").select(
        "window_id",
        "begin_date",
        "end_date",
        F.coalesce("_n", F.lit(0).cast("bigint")).alias("row_count"),
    )
    in_order = W.orderBy("begin_date").rowsBetween(W.unboundedPreceding, W.currentRow)
    return sized.withColumns(
        {
            "target_row_count": F.sum("row_count").over(in_order),
            "zero_rows": F.col("row_count") == 0,
        }
    )


def remainder(days: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows of a measured source that no window covers: ``undated`` and ``outside``.

    ``days`` has a row per day (missing for rows without a date) with its row_count; with the rows
    of the windows they add up to the source's count.
    """
    covered = windows.select(F.explode(F.sequence("begin_date", "end_date")).alias("_day"))
    left = days.join(covered.distinct(), F.col("day") == F.col("_day"), "left_anti")
    undated = F.col("day").isNull()
    found = left.agg(
        *[
            F.coalesce(F.sum(F.when(hit, F.col("row_count"))), F.lit(0)).cast("bigint").alias(name)
            for name, hit in ((UNDATED, undated), (OUTSIDE, ~undated))
        ]
    )
    return found.select(
        F.explode(F.array(*[
            F.struct(F.lit(name).alias("window_id"), F.col(name).alias("row_count"))
            for name in (UNDATED, OUTSIDE)
        ])).alias("x")
    ).select("x.*")


def stats_put_if_absent(stats: DataFrame, new: DataFrame) -> DataFrame:
    """Adds items whose file name is new, the earliest of several; existing items win."""
    columns = stats.columns
    first = (
        new.groupBy("file_name")
        .agg(F.min(F.struct("extract_start", F.struct(*columns).alias("row"))).alias("best"))
        .select("best.row.*")
    )
    known = stats.select(F.col("file_name").alias("_known"))
    fresh = first.join(known, F.col("file_name") == F.col("_known"), "left_anti")
    return stats.unionByName(fresh.withColumn("extract_status", F.lit(IN_PROGRESS)))


def stats_transition(stats: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Moves items on by what happened to their file.

    ``outcomes`` has ``file_name``, ``outcome`` (loaded, empty, extract_failed), ``target_rows``,
    ``inserted_rows``, ``updated_rows``, ``load_error``, ``load_error_message``, ``extract_error``,
    ``extract_end`` and ``load_end``; ``source_rows`` and ``extract_start`` where they are known
    only now.
    """
    late = [c for c in ("source_rows", "extract_start") if c in outcomes.columns]
    happened = outcomes.selectExpr(
        "file_name AS _key",
        "outcome AS _o",
        "CAST(target_rows AS STRING) AS _target",
        "CAST(inserted_rows AS STRING) AS _inserted",
        "CAST(updated_rows AS STRING) AS _updated",
        "CAST(inserted_rows + updated_rows AS STRING) AS _processed",
        "coalesce(load_error, false) AS _load_error",
        "load_error_message AS _load_message",
        "extract_error AS _extract_message",
        "extract_end AS _extract_end",
        "load_end AS _load_end",
        *[f"CAST({c} AS STRING) AS _{c}" for c in late],
    )
    loaded, empty, failed = (f"_o = '{o}'" for o in ("loaded", "empty", "extract_failed"))
    moves = {
        "extract_status": f"CASE WHEN {failed} THEN '{FAILED}'"
        f" WHEN _o IS NOT NULL THEN '{SUCCESS}' END",
        "extract_end": "_extract_end",
        "extract_failure": f"CASE WHEN {failed} THEN _extract_message END",
        "load_start": f"CASE WHEN {loaded} THEN _extract_end WHEN {empty} THEN '' END",
        "load_status": f"CASE WHEN {empty} THEN '{NO_ROWS}' WHEN {loaded} AND _load_error"
        f" THEN '{FAILED}' WHEN {loaded} THEN '{SUCCESS}' END",
    }
    for name, value in {
        "load_end": "_load_end",
        "load_failure": "_load_message",
        "target_rows": "_target",
        "inserted_rows": "_inserted",
        "updated_rows": "_updated",
        "processed_rows": "_processed",
    }.items():
        moves[name] = f"CASE WHEN {loaded} THEN {value} END"
    moves.update({c: f"_{c}" for c in late})
    joined = stats.join(happened, F.col("file_name") == F.col("_key"), "left")
    return joined.selectExpr(
        *[f"coalesce({moves[c]}, {c}) AS {c}" if c in moves else c for c in stats.columns]
    )


def control_snapshot(
    control: DataFrame, priority: int | str | None = None, instance: str | None = None
) -> DataFrame:
    """The control rows of an export, in work order."""
    return order_work(apply_run_args(select_snapshot(control), priority, instance))


def export_control_snapshot(
    control: DataFrame,
    path: str,
    priority: int | str | None = None,
    instance: str | None = None,
) -> None:
    """Ordered CSV export. A small table is one file; a large one is files in name order."""
    control_snapshot(control, priority, instance).write.mode("overwrite").options(
        **CSV_OPTIONS
    ).csv(path)


def stats_item(stats: DataFrame, file_name: str) -> DataFrame:
    return stats.filter(F.col("file_name") == file_name)


def export_stats_item(stats: DataFrame, file_name: str, path: str) -> None:
    stats_item(stats, file_name).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
