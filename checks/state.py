"""Reconciliation, control updates and load statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from tidegate.operators import reconcile as R
from tidegate.schemas import CONTROL, LOAD_STATS
from tidegate.session import work_path
from tidegate.sources.landing import read_landing_csv

_TALLIED = f"""results AS ({fx.RESULTS_SQL}),
settled AS (SELECT *, CASE WHEN load_type IN ('CDC', 'Special_CDC') THEN rows_after - rows_before
      ELSE rows_after END AS inserted_rows,
  CASE WHEN load_type IN ('CDC', 'Special_CDC') THEN processed - (rows_after - rows_before)
      ELSE 0 END AS updated_rows,
  source_count - rows_after AS count_difference,
  CASE WHEN source_count = rows_after AND promote AND NOT load_error AND load_type = 'Full' THEN 'CDC'
       WHEN source_count = rows_after AND promote AND NOT load_error AND load_type = 'Special_Full'
         THEN 'Special_CDC' ELSE load_type END AS next_load_type,
  CASE WHEN load_error THEN prior_update_date ELSE finished_at END AS next_update_date FROM results)"""
_WITH = f"WITH {_TALLIED}"


def _settled(spark, sf):
    return R.settle(fx.results(spark, sf))


@query(
    f"{_WITH} SELECT table_uid, load_type, rows_before, rows_after, processed,"
    " inserted_rows, updated_rows FROM settled"
)
def load_tally(spark, sf):
    return R.load_tally(fx.results(spark, sf)).select(
        "table_uid",
        "load_type",
        "rows_before",
        "rows_after",
        "processed",
        "inserted_rows",
        "updated_rows",
    )


@query(f"{_WITH} SELECT table_uid, count_difference FROM settled")
def count_difference(spark, sf):
    return R.count_difference(fx.results(spark, sf)).select("table_uid", "count_difference")


@query(f"{_WITH} SELECT table_uid, load_type, next_load_type FROM settled")
def next_load_type(spark, sf):
    return R.next_load_type(fx.results(spark, sf)).select(
        "table_uid", "load_type", "next_load_type"
    )


@query(
    f"""{_WITH} SELECT table_uid, CASE WHEN source_count = rows_after THEN 'CDC' ELSE 'Full' END
  AS next_load_type FROM results WHERE load_type = 'Full'"""
)
def next_load_type_subbatch(spark, sf):
    full = fx.results(spark, sf).filter(F.col("load_type") == "Full")
    return R.next_load_type_subbatch(full).select("table_uid", "next_load_type")


@query(
    f"""{_WITH} SELECT table_uid, CASE WHEN source_count = rows_after AND NOT load_error
    AND load_type = 'Full' THEN 'CDC' ELSE load_type END AS next_load_type FROM results"""
)
def next_load_type_full_only(spark, sf):
    """The windowed rule: only full loads move, whatever the flag."""
    moved = R.next_load_type(fx.results(spark, sf), ignore_flag=True, types=["Full"])
    return moved.select("table_uid", "next_load_type")


@query(
    f"{_WITH} SELECT table_uid, load_type AS next_load_type FROM results"
    " WHERE load_type LIKE 'MetaData%' OR load_type = 'FreeForm'"
)
def no_promotion(spark, sf):
    kinds = F.col("load_type").like("MetaData%") | (F.col("load_type") == "FreeForm")
    moved = R.next_load_type(fx.results(spark, sf).filter(kinds), ignore_flag=True)
    return moved.select("table_uid", "next_load_type")


@query(f"{_WITH} SELECT table_uid, load_error, next_update_date FROM settled")
def advance_watermark(spark, sf):
    return R.advance_watermark(fx.results(spark, sf)).select(
        "table_uid", "load_error", "next_update_date"
    )


# keyed merges into the control table -------------------------------------------------------------


def _merged(new: dict[str, str], where: str) -> str:
    """SQL of control with ``new`` columns where a result passes ``where``."""
    shown = [
        f"CASE WHEN r.table_uid IS NOT NULL THEN {new[f.name]} ELSE c.{f.name} END AS {f.name}"
        if f.name in new
        else f"c.{f.name}"
        for f in CONTROL.fields
    ]
    return f"""{_WITH}, control AS ({fx.CONTROL_SQL})
SELECT {', '.join(shown)} FROM control c
LEFT JOIN (SELECT * FROM settled WHERE {where}) r ON c.table_uid = r.table_uid"""


_BATCH = {
    "last_update_date": "r.next_update_date",
    "source_row_count": "r.source_count",
    "target_row_count": "r.rows_after",
    "extract_error": "r.extract_error",
    "counted_at": "r.finished_at",
    "min_update_date": "r.min_update_date",
    "max_update_date": "r.max_update_date",
    "created": "true",
    "load_type": "r.next_load_type",
    "zero_rows": "false",
}
_SUCCESS = {
    **_BATCH,
    "load_error": "r.load_error",
    "load_error_message": "r.load_error_message",
    "inserted_rows": "r.inserted_rows",
    "updated_rows": "r.updated_rows",
}


def _outcome(spark, sf, outcome):
    return _settled(spark, sf).filter(F.col("outcome") == outcome)


@query(_merged(_SUCCESS, "outcome = 'loaded'"), as_text=fx.NULLABLE)
def apply_success(spark, sf):
    return R.apply_success(fx.control(spark, sf), _outcome(spark, sf, "loaded"))


@query(
    _merged({"last_update_date": "r.finished_at", "zero_rows": "true"}, "outcome = 'empty'"),
    as_text=fx.NULLABLE,
)
def apply_zero_rows(spark, sf):
    return R.apply_zero_rows(fx.control(spark, sf), _outcome(spark, sf, "empty"))


@query(
    _merged(
        {
            "source_row_count": "r.source_count",
            "target_row_count": "0",
            "extract_error": "r.extract_error",
            "counted_at": "r.finished_at",
            "min_update_date": "r.min_update_date",
            "max_update_date": "r.max_update_date",
            "created": "true",
            "load_type": "r.load_type",
            "zero_rows": "false",
            "load_error": "false",
            "load_error_message": "''",
            "inserted_rows": "0",
            "updated_rows": "0",
        },
        "outcome = 'extract_failed'",
    ),
    as_text=fx.NULLABLE,
)
def apply_extract_failure(spark, sf):
    return R.apply_extract_failure(fx.control(spark, sf), _outcome(spark, sf, "extract_failed"))


@query(
    _merged(
        {
            **_SUCCESS,
            "load_error": "r.load_error",
            "load_error_message": "CASE WHEN r.load_error THEN r.load_error_message ELSE '' END",
            "inserted_rows": "CASE WHEN r.load_error THEN r.inserted_rows END",
            "updated_rows": "CASE WHEN r.load_error THEN r.updated_rows END",
            "schedule": "CASE WHEN r.load_error THEN c.schedule ELSE 'false' END",
        },
        "outcome = 'loaded'",
    ),
    as_text=fx.NULLABLE,
)
def apply_schedule_done(spark, sf):
    return R.apply_schedule_done(fx.control(spark, sf), _outcome(spark, sf, "loaded"))


@query(_merged(_BATCH, "outcome = 'loaded'"), as_text=fx.NULLABLE)
def apply_batch_progress(spark, sf):
    return R.apply_batch_progress(fx.control(spark, sf), _outcome(spark, sf, "loaded"))


# statistics --------------------------------------------------------------------------------------

_KNOWN = "c_acctbal < 4000"  # files already listed
_LATER = {"extract_start": "'1998-06-16 00:00:00'", "zone": "'raw'"}


def _new_picks() -> list[str]:
    shown = []
    for f, text in zip(LOAD_STATS.fields, fx.STATS_PICKS, strict=True):
        shown.append(f"{_LATER[f.name]} AS {f.name}" if f.name in _LATER else text)
    return shown


@query(
    f"""SELECT {', '.join(fx.STATS_PICKS)} FROM customer WHERE {_KNOWN}
UNION ALL SELECT {', '.join(_new_picks())} FROM customer WHERE NOT ({_KNOWN})"""
)
def stats_put_if_absent(spark, sf):
    """Listed files keep their item; new ones are added once although given twice."""
    customer = fx.table(spark, sf, "customer")
    known = customer.filter(_KNOWN).selectExpr(*fx.STATS_PICKS)
    new = customer.selectExpr(*_new_picks())
    again = new.withColumn("extract_start", F.lit("1998-06-17 00:00:00"))
    return R.stats_put_if_absent(known, new.unionByName(again))


# what happened to the files, from the orders of each customer
_OUTCOMES = """SELECT concat(replace(c_name, '#', '_'), '.csv') AS file_name,
  CASE c_custkey % 4 WHEN 0 THEN 'empty' WHEN 1 THEN 'extract_failed' ELSE 'loaded' END AS outcome,
  count(o_orderkey) AS target_rows, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS inserted_rows,
  count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS updated_rows, c_custkey % 8 = 3 AS load_error,
  CASE WHEN c_custkey % 8 = 3 THEN 'value does not fit' ELSE '' END AS load_error_message,
  CASE WHEN c_custkey % 4 = 1 THEN 'source not reached' ELSE '' END AS extract_error,
  '1998-06-15 10:00:00' AS extract_end, '1998-06-15 11:00:00' AS load_end
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
WHERE c_mktsegment <> 'BUILDING' GROUP BY c_custkey, c_name"""

_MOVES = {
    "extract_status": "CASE WHEN outcome = 'extract_failed' THEN 'Failed' ELSE 'Success' END",
    "extract_end": "o.extract_end",
    "extract_failure": "CASE WHEN outcome = 'extract_failed' THEN extract_error END",
    "load_start": "CASE outcome WHEN 'loaded' THEN o.extract_end WHEN 'empty' THEN '' END",
    "load_status": "CASE WHEN outcome = 'loaded' AND load_error THEN 'Failed'"
    " WHEN outcome = 'loaded' THEN 'Success' WHEN outcome = 'empty'"
    " THEN 'Success - No rows returned' END",
    "load_end": "CASE WHEN outcome = 'loaded' THEN o.load_end END",
    "load_failure": "CASE WHEN outcome = 'loaded' THEN load_error_message END",
    "target_rows": "CASE WHEN outcome = 'loaded' THEN CAST(o.target_rows AS VARCHAR) END",
    "inserted_rows": "CASE WHEN outcome = 'loaded' THEN CAST(o.inserted_rows AS VARCHAR) END",
    "updated_rows": "CASE WHEN outcome = 'loaded' THEN CAST(o.updated_rows AS VARCHAR) END",
    "processed_rows": "CASE WHEN outcome = 'loaded' THEN"
    " CAST(o.inserted_rows + o.updated_rows AS VARCHAR) END",
}


@query(
    f"WITH stats AS ({fx.STATS_SQL}), outcomes AS ({_OUTCOMES}) SELECT "
    + ", ".join(
        f"CASE WHEN o.file_name IS NULL THEN s.{n} ELSE {_MOVES[n]} END AS {n}"
        if n in _MOVES
        else f"s.{n}"
        for n in LOAD_STATS.fieldNames()
    )
    + " FROM stats s LEFT JOIN outcomes o ON s.file_name = o.file_name"
)
def stats_transition(spark, sf):
    outcomes = fx.run_sql(spark, sf, _OUTCOMES, "customer", "orders")
    return R.stats_transition(fx.stats(spark, sf), outcomes)


@query(f"SELECT file_name, feed, source_rows, extract_start, extract_status FROM ({fx.STATS_SQL}) s"
       " WHERE file_name = 'Customer_000000077.csv'")
def export_stats_item(spark, sf):
    path = work_path(spark, "export")
    R.export_stats_item(fx.stats(spark, sf), "Customer_000000077.csv", path)
    return read_landing_csv(spark, path, LOAD_STATS.fieldNames()).select(
        "file_name", "feed", "source_rows", "extract_start", "extract_status"
    )
