"""Selection, routing, naming and order of control rows."""

from __future__ import annotations

from checks import fixtures as fx
from checks.registry import query
from tidegate.operators import reconcile as R
from tidegate.operators import selection as sel
from tidegate.session import work_path
from tidegate.sources.landing import read_landing_csv

_CONTROL = f"WITH control AS ({fx.CONTROL_SQL})"
_READY = "frequency = 'Daily' AND active AND created"
_REGULAR = (
    f"{_READY} AND schedule = 'false' AND load_type IN"
    " ('CDC', 'Full', 'Validation', 'Special_Full', 'Special_CDC', 'MetaData')"
)
_SCHEDULED = (
    f"{_READY} AND load_type IN ('Full', 'Special_Full')"
    " AND schedule IN ('true', 'Full', 'Batches', 'Manual')"
)


def _select(where: str, columns: str = fx.KEYS) -> str:
    return f"{_CONTROL} SELECT {columns} FROM control WHERE {where}"


def _keys(df):
    return df.select(*[c.strip() for c in fx.KEYS.split(",")])


@query(_select(_REGULAR))
def select_regular(spark, sf):
    return _keys(sel.select_regular(fx.control(spark, sf)))


@query(_select(f"{_REGULAR} AND batched"))
def select_batched(spark, sf):
    return _keys(sel.select_batched(fx.control(spark, sf)))


@query(_select(_SCHEDULED))
def select_scheduled(spark, sf):
    return _keys(sel.select_scheduled(fx.control(spark, sf)))


@query(_select("active AND created AND load_type IN ('MetaData_Cols', 'MetaData_primarykeys')"))
def select_metadata(spark, sf):
    return _keys(sel.select_metadata(fx.control(spark, sf)))


@query(_select("frequency = 'Daily' AND active AND load_type = 'FreeForm'"))
def select_freeform(spark, sf):
    return _keys(sel.select_freeform(fx.control(spark, sf)))


@query(_select(_READY))
def select_snapshot(spark, sf):
    return _keys(sel.select_snapshot(fx.control(spark, sf)))


@query(_select("priority = 2 AND instance = 'prod'"))
def apply_run_args(spark, sf):
    return _keys(sel.apply_run_args(fx.control(spark, sf), priority="2", instance="prod"))


@query(_select("true"))
def apply_run_args_all(spark, sf):
    return _keys(sel.apply_run_args(fx.control(spark, sf), priority="All", instance="All"))


@query(
    _select(
        "last_update_date IS NULL OR substring(last_update_date, 1, 10) <> '1998-06-15'",
        f"{fx.KEYS}, last_update_date",
    )
)
def once_per_day_gate(spark, sf):
    df = sel.once_per_day_gate(fx.control(spark, sf), fx.AS_OF)
    return df.select(*[c.strip() for c in fx.KEYS.split(",")], "last_update_date")


@query(
    f"{_CONTROL} SELECT {fx.KEYS}, CASE WHEN batched AND load_type = 'Full' THEN 'batched'"
    " ELSE 'regular' END AS route FROM control"
)
def route(spark, sf):
    df = sel.route(fx.control(spark, sf))
    return df.select(*[c.strip() for c in fx.KEYS.split(",")], "route")


@query(
    f"""{_CONTROL} SELECT table_uid, load_type, CASE
  WHEN load_type = 'Validation' THEN validation_table
  WHEN load_type IN ('MetaData', 'MetaData_Cols', 'MetaData_primarykeys')
    THEN concat(source_table, '_All_23B')
  ELSE source_table END AS target_table FROM control"""
)
def resolve_target(spark, sf):
    df = sel.resolve_target(fx.control(spark, sf), release="23B")
    return df.select("table_uid", "load_type", "target_table")


@query(
    f"""{_CONTROL} SELECT table_uid, load_type, concat('raw/', CASE
  WHEN load_type IN ('CDC', 'Special_CDC') THEN 'CDC'
  WHEN load_type = 'Validation' THEN 'Validation'
  WHEN load_type LIKE 'MetaData%' THEN 'MetaData'
  ELSE 'FullTableLoads' END, '/', source_table, '/1998/06/15/') AS raw_prefix FROM control"""
)
def raw_prefix(spark, sf):
    df = sel.raw_prefix(fx.control(spark, sf), fx.AS_OF, "raw")
    return df.select("table_uid", "load_type", "raw_prefix")


@query(_select(_REGULAR) + " ORDER BY priority, sort_order, table_uid")
def order_work(spark, sf):
    return _keys(sel.order_work(sel.select_regular(fx.control(spark, sf))))


@query(
    f"""{_CONTROL} SELECT table_uid, source_table, load_type, CAST(priority AS VARCHAR) AS priority,
  CAST(sort_order AS VARCHAR) AS sort_order, CAST(active AS VARCHAR) AS active,
  CAST(batched AS VARCHAR) AS batched, CAST(schedule_begin AS VARCHAR) AS schedule_begin
FROM control WHERE {_READY} AND instance = 'test'"""
)
def export_control_snapshot(spark, sf):
    path = work_path(spark, "export")
    R.export_control_snapshot(fx.control(spark, sf), path, instance="test")
    return read_landing_csv(spark, path).select(
        "table_uid",
        "source_table",
        "load_type",
        "priority",
        "sort_order",
        "active",
        "batched",
        "schedule_begin",
    )
