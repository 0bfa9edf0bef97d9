"""Frames derived from the given tables, once for Spark and once as SQL text.

Expressions are shared between the two wherever both engines read them alike.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.schemas import CONTROL, LOAD_STATS
from tidegate.sources.control import parse_control

AS_OF = date(1998, 6, 15)
DATA_END = date(2002, 12, 31)  # after every order and its updates
SINCE = date(1998, 3, 1)
EVENTS_AS_OF = date(2024, 3, 10)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def picks(exprs: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in exprs.items()]


# orders as a source table: created on the order date, updated some days and hours later -------

SRC_ORDERS_SQL = """SELECT *, o_orderdate AS creation_date,
  o_orderdate + (o_orderkey % 40) * INTERVAL 1 DAY + (o_orderkey % 24) * INTERVAL 1 HOUR
    AS last_update_date
FROM orders"""


def src_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "*",
        "o_orderdate AS creation_date",
        "o_orderdate + make_dt_interval(cast(o_orderkey % 40 AS int), cast(o_orderkey % 24 AS int))"
        " AS last_update_date",
    )


# The target as an earlier run left it: what was created before a day, with the old price where
# the row has been updated since.


def tgt_orders_sql(day: str) -> str:
    return f"""SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN CAST(last_update_date AS DATE) >= DATE '{day}' THEN o_totalprice - 1
       ELSE o_totalprice END AS o_totalprice,
  o_orderdate, o_orderpriority, creation_date, last_update_date
FROM src WHERE CAST(creation_date AS DATE) < DATE '{day}'"""


def tgt_orders(spark: SparkSession, sf: str, day: str) -> DataFrame:
    text = tgt_orders_sql(day).replace("FROM src", "FROM {src}")
    return spark.sql(text, src=src_orders(spark, sf))


# events with their own time as the update date ------------------------------------------------

SRC_EVENTS_SQL = """SELECT event_id, ts AS last_update_date, user_id, event_type, value, props
FROM events"""


def src_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumnRenamed("ts", "last_update_date")


# a control table with one row per part --------------------------------------------------------

LOAD_TYPE = """CASE p_partkey % 11
  WHEN 0 THEN 'CDC' WHEN 1 THEN 'Full' WHEN 2 THEN 'Validation' WHEN 3 THEN 'Special_Full'
  WHEN 4 THEN 'Special_CDC' WHEN 5 THEN 'MetaData' WHEN 6 THEN 'MetaData_Cols'
  WHEN 7 THEN 'MetaData_primarykeys' WHEN 8 THEN 'FreeForm' WHEN 9 THEN 'Full'
  ELSE 'Paused' END"""

CONTROL_TEXT = {
    "table_uid": "concat('T', lpad(cast(p_partkey AS string), 9, '0'))",
    "source_table": "replace(p_name, ' ', '_')",
    "target_schema": "lower(p_type)",
    "frequency": "CASE WHEN p_size % 9 = 0 THEN 'Weekly' ELSE 'Daily' END",
    "active": "CASE WHEN p_size % 7 = 0 THEN 'false' WHEN p_size % 11 = 0 THEN NULL ELSE 'true' END",
    "created": "CASE WHEN p_partkey % 13 = 0 THEN 'false' ELSE 'true' END",
    "load_type": LOAD_TYPE,
    "schedule": "CASE p_size % 8 WHEN 1 THEN 'true' WHEN 2 THEN 'Full' WHEN 3 THEN 'Batches'"
    " WHEN 4 THEN 'Manual' ELSE 'false' END",
    "batched": "CASE WHEN p_size % 3 = 0 THEN 'true' WHEN p_size % 3 = 1 THEN 'false' END",
    "priority": "cast(p_partkey % 5 AS string)",
    "sort_order": "cast(p_size AS string)",
    "instance": "CASE WHEN p_partkey % 2 = 0 THEN 'prod' ELSE 'test' END",
    "primary_key": "'p_partkey'",
    "return_fields": "'p_partkey, p_name'",
    "promote": "CASE WHEN p_size % 4 = 0 THEN 'false' ELSE 'true' END",
    "has_update_date": "CASE WHEN p_size % 5 = 0 THEN 'false' WHEN p_size % 5 = 1 THEN 'true' END",
    "last_update_date": "CASE p_partkey % 4 WHEN 0 THEN '1998-06-15 03:04:05'"
    " WHEN 1 THEN '1998-06-14 23:59:59' WHEN 2 THEN '' END",
    "validation_table": "concat('chk_', lower(p_type))",
    "schedule_truncate": "CASE WHEN p_partkey % 3 = 0 THEN 'true' ELSE 'false' END",
    "schedule_begin": "'1998-02-10'",
    "schedule_end": "'1998-03-05'",
    "freeform_sql": "'SELECT 1 AS one'",
    "freeform_truncate": "CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END",
    "source_row_count": "cast(p_size * 100 AS string)",
    "target_row_count": "''",
}

_BOOLS = {f.name for f in CONTROL.fields if f.dataType.typeName() == "boolean"}
_CASTS = {"integer": "INTEGER", "long": "BIGINT", "date": "DATE"}


def _typed(field) -> str:
    """SQL of a control field parsed from its text."""
    text = CONTROL_TEXT.get(field.name, "NULL")
    kind = field.dataType.typeName()
    if field.name == "has_update_date":
        return f"coalesce(({text}) <> 'false', true) AS {field.name}"
    if field.name in _BOOLS:
        return f"coalesce(CAST(({text}) AS VARCHAR) = 'true', false) AS {field.name}"
    if kind in _CASTS:
        return f"CAST(nullif({text}, '') AS {_CASTS[kind]}) AS {field.name}"
    return f"CAST({text} AS VARCHAR) AS {field.name}"


CONTROL_SQL = "SELECT " + ",\n  ".join(_typed(f) for f in CONTROL.fields) + "\nFROM part"

# control columns that are dates or may lack a number
NULLABLE = "schedule_begin schedule_end target_row_count inserted_rows updated_rows"

# columns shown by selection queries
KEYS = "table_uid, load_type, schedule, batched, priority, sort_order, instance"


def control_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(*picks(CONTROL_TEXT))


def control(spark: SparkSession, sf: str) -> DataFrame:
    return parse_control(control_text(spark, sf))


# run results: one per part, with counts taken from its line items -------------------------------

RESULT_EXPRS = {
    "table_uid": CONTROL_TEXT["table_uid"],
    "load_type": LOAD_TYPE,
    "outcome": "CASE WHEN p_size % 10 = 3 THEN 'empty' WHEN p_size % 10 = 4 THEN 'extract_failed'"
    " ELSE 'loaded' END",
    "source_count": "n_all",
    "min_update_date": "cast(CASE WHEN p_size % 6 = 0 THEN NULL ELSE '1997-01-02 00:00:00' END"
    " AS string)",
    "max_update_date": "'1998-06-14 11:00:00'",
    "rows_before": "n_open",
    "rows_after": "CASE WHEN n_returned % 2 = 0 THEN n_all ELSE n_open + n_returned END",
    "processed": "n_all - n_open + n_returned",
    "load_error": "p_size % 10 = 5",
    "load_error_message": "CASE WHEN p_size % 10 = 5 THEN 'value does not fit' ELSE '' END",
    "extract_error": "CASE WHEN p_size % 10 = 4 THEN 'source not reached' ELSE '' END",
    "promote": "p_partkey % 3 <> 0",
    "prior_update_date": "'1998-06-14 05:00:00'",
    "finished_at": "concat('1998-06-15 0', cast(p_partkey % 10 AS string), ':00:00')",
}

_SIZES = {
    "n_all": "count(*)",
    "n_open": "count(CASE WHEN l_linestatus = 'O' THEN 1 END)",
    "n_returned": "count(CASE WHEN l_returnflag = 'R' THEN 1 END)",
}

RESULTS_SQL = (
    "SELECT "
    + ",\n  ".join(picks(RESULT_EXPRS))
    + "\nFROM part JOIN (SELECT l_partkey, "
    + ", ".join(picks(_SIZES))
    + " FROM lineitem GROUP BY l_partkey) s ON p_partkey = l_partkey"
)


def results(spark: SparkSession, sf: str) -> DataFrame:
    sizes = (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey")
        .agg(*[F.expr(sql).alias(name) for name, sql in _SIZES.items()])
    )
    part = table(spark, sf, "part")
    return part.join(sizes, F.col("p_partkey") == F.col("l_partkey")).selectExpr(
        *picks(RESULT_EXPRS)
    )


# statistics: one file per customer ------------------------------------------------------------

STATS_EXPRS = {
    "file_name": "concat(replace(c_name, '#', '_'), '.csv')",
    "project": "'base'",
    "feed": "lower(c_mktsegment)",
    "year": "'1998'",
    "month": "'06'",
    "day": "'15'",
    "source_rows": "cast(c_nationkey AS string)",
    "extract_start": "concat('1998-06-15 0', cast(c_custkey % 10 AS string), ':00:00')",
    "extract_status": "'In Progress'",
    "target_schema": "'sales'",
    "table_uid": "cast(c_custkey AS string)",
    "target_table": "lower(c_mktsegment)",
}


def _stats_field(name: str) -> str:
    return f"{STATS_EXPRS.get(name, 'CAST(NULL AS string)')} AS {name}"


STATS_PICKS = [_stats_field(f.name) for f in LOAD_STATS.fields]
STATS_SQL = "SELECT " + ", ".join(STATS_PICKS) + " FROM customer"


def stats(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(*STATS_PICKS)


# catalogs -------------------------------------------------------------------------------------

CONSTRAINTS_SQL = """SELECT cast(o_orderkey % 2 AS string) AS owner,
  cast(o_orderkey AS string) AS constraint_name, o_orderstatus AS constraint_type,
  o_orderpriority AS status FROM orders"""

CONS_COLUMNS_SQL = """SELECT cast(l_orderkey % 2 AS string) AS owner,
  cast(l_orderkey AS string) AS constraint_name, l_returnflag AS table_name,
  cast(l_partkey AS string) AS column_name, l_linenumber AS position FROM lineitem"""

COLUMNS_SQL = """SELECT p_brand AS owner,
  CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS table_name,
  cast(p_partkey AS string) AS column_name,
  CASE WHEN p_size = 50 THEN NULL ELSE p_type END AS data_type FROM part"""

OWNER = "Brand#7"
TEXT_TYPE = "ECONOMY"


def run_sql(spark: SparkSession, sf: str, sql: str, *names: str) -> DataFrame:
    """The shared SQL text over given tables, which stand behind FROM or JOIN; no view stays behind."""
    text = sql
    for name in names:
        text = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
    return spark.sql(text, **{name: table(spark, sf, name) for name in names})


def constraints(spark: SparkSession, sf: str) -> DataFrame:
    return run_sql(spark, sf, CONSTRAINTS_SQL, "orders")


def cons_columns(spark: SparkSession, sf: str) -> DataFrame:
    return run_sql(spark, sf, CONS_COLUMNS_SQL, "lineitem")


def catalog_columns(spark: SparkSession, sf: str) -> DataFrame:
    return run_sql(spark, sf, COLUMNS_SQL, "part")
