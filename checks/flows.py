"""Whole flows: a control table is written, a run is made, its targets or its control come back."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.loads import BY_YEAR, _upserted_sql
from checks.registry import query
from checks.sources import _COLUMNS, _FREEFORM, _NAMED, CAUGHT_UP, PRIMARY_KEYS_SQL, SRC
from checks.windows import _MONTHS
from tidegate.operators import reconcile as R
from tidegate.plans import flows as runs
from tidegate.plans.loads import read_target, replace_load
from tidegate.schemas import CONTROL
from tidegate.session import small_frame, work_path
from tidegate.sources.control import parse_control
from tidegate.sources.landing import text_schema

AT = datetime(1998, 6, 15, 4, 5, 6)

_READY = {
    "target_schema": "dw",
    "frequency": "Daily",
    "active": "true",
    "created": "true",
    "schedule": "false",
    "batched": "false",
    "instance": "prod",
    "promote": "true",
    "has_update_date": "true",
    "last_update_date": "1998-06-14 04:00:00",
}


def make_run(spark, sf, items, read=None, **settings):
    """A run over its own folder; ``items`` are control rows over the ready defaults."""
    root = work_path(spark, "run")
    rows = [{**_READY, "sort_order": str(i), "priority": "1", **item}
            for i, item in enumerate(items)]
    text = small_frame(spark, rows, text_schema(CONTROL.fieldNames()))
    tables = {
        "orders_src": lambda: fx.src_orders(spark, sf),
        "events_src": lambda: fx.src_events(spark, sf),
        "lineitem": lambda: fx.table(spark, sf, "lineitem"),
        "all_constraints": lambda: fx.constraints(spark, sf),
        "all_cons_columns": lambda: fx.cons_columns(spark, sf),
        "catalog": lambda: fx.catalog_columns(spark, sf),
        **(read or {}),
    }
    run = runs.IngestRun(
        spark=spark,
        read=lambda name: tables[name](),
        control_path=f"{root}/control",
        stats_path=f"{root}/stats",
        raw_root=f"{root}/raw",
        target_root=f"{root}/targets",
        as_of=fx.AS_OF,
        clock=lambda: AT,
        **settings,
    )
    runs.start_control(spark, parse_control(text), run.control_path)
    return run


@query(_upserted_sql(str(fx.SINCE), CAUGHT_UP))
def regular_change_flow(spark, sf):
    run = make_run(
        spark,
        sf,
        [{"table_uid": "orders", "source_table": "orders_src", "load_type": "CDC",
          "primary_key": "o_orderkey"}],
        since=fx.SINCE,
    )
    target = f"{run.target_root}/dw/orders_src"
    replace_load(fx.tgt_orders(spark, sf, str(fx.SINCE)), target, BY_YEAR)
    runs.run_regular(run)
    return read_target(spark, target)


@query(
    f"""{SRC}, n AS (SELECT count(*) AS orders_n, (SELECT count(*) FROM lineitem) AS lines_n FROM src)
SELECT 'lines' AS table_uid, 'CDC' AS load_type, lines_n AS source_row_count,
  lines_n AS target_row_count, lines_n AS inserted_rows, CAST(0 AS BIGINT) AS updated_rows,
  '1998-06-15 04:05:06' AS last_update_date, false AS zero_rows, false AS load_error FROM n
UNION ALL SELECT 'orders', 'Special_CDC', orders_n, orders_n, orders_n, 0, '1998-06-15 04:05:06', false,
  false FROM n
UNION ALL SELECT 'check', 'Validation', orders_n, orders_n, orders_n, 0, '1998-06-15 04:05:06', false,
  false FROM n
UNION ALL SELECT 'done', 'Full', NULL, NULL, NULL, NULL, '1998-06-15 01:00:00', false, false FROM n""",
    as_text="source_row_count target_row_count inserted_rows updated_rows",
)
def regular_full_flow(spark, sf):
    """Control after full, projected and validation loads; what ran today is left alone."""
    run = make_run(
        spark,
        sf,
        [
            {"table_uid": "lines", "source_table": "lineitem", "load_type": "Full",
             "has_update_date": "false"},
            {"table_uid": "orders", "source_table": "orders_src", "load_type": "Special_Full",
             "return_fields": "o_orderkey, upper(o_orderstatus) AS status"},
            {"table_uid": "check", "source_table": "orders_src", "load_type": "Validation",
             "return_fields": "o_orderkey", "validation_table": "orders_chk"},
            {"table_uid": "done", "source_table": "orders_src", "load_type": "Full",
             "last_update_date": "1998-06-15 01:00:00"},
        ],
    )
    runs.run_regular(run)
    return run.control().select(
        "table_uid",
        "load_type",
        "source_row_count",
        "target_row_count",
        "inserted_rows",
        "updated_rows",
        "last_update_date",
        "zero_rows",
        "load_error",
    )


@query(
    f"{_MONTHS} SELECT src.* FROM src JOIN months w"
    " ON CAST(last_update_date AS DATE) BETWEEN w.begin_date AND w.end_date"
)
def batched_full_flow(spark, sf):
    """Windows from measured bytes, staged per window, loaded in one pass."""
    run = make_run(
        spark,
        sf,
        [{"table_uid": "orders", "source_table": "orders_src", "load_type": "Full",
          "batched": "true"}],
        window_cost="byte_count",
        window_limit=65_536,
    )
    runs.run_batched(run)
    return read_target(spark, f"{run.target_root}/dw/orders_src")


@query(
    f"""{_MONTHS}, sizes AS (SELECT w.window_id, w.begin_date, w.end_date, count(o_orderkey) AS row_count
  FROM months w LEFT JOIN src ON CAST(last_update_date AS DATE) BETWEEN w.begin_date AND w.end_date
  GROUP BY 1, 2, 3)
SELECT 'orders' AS table_uid, '1998-06-15 04:05:06' AS loaded_at, *,
  CAST(sum(row_count) OVER (ORDER BY begin_date) AS BIGINT) AS target_row_count,
  row_count = 0 AS zero_rows FROM sizes""",
    as_text="begin_date end_date",
)
def batched_window_status(spark, sf):
    """The progress rows of a split load's date windows, from the loaded rows."""
    return _window_rows(spark, sf).where("begin_date IS NOT NULL")


def _window_rows(spark, sf):
    run = make_run(
        spark,
        sf,
        [{"table_uid": "orders", "source_table": "orders_src", "load_type": "Full",
          "batched": "true"}],
    )
    runs.run_batched(run)
    return read_target(spark, run.windows_path)


@query(
    f"""{SRC}, n AS (SELECT count(*) AS c,
  count(CASE WHEN CAST(last_update_date AS DATE) <= DATE '1998-06-30' THEN 1 END) AS inside FROM src)
SELECT 'windows' AS part, inside AS row_count FROM n
UNION ALL SELECT 'undated', 0 FROM n UNION ALL SELECT 'outside', c - inside FROM n"""
)
def batched_window_remainder(spark, sf):
    """Rows in windows, without a date and beyond all windows: together, all rows of the source."""
    part = F.when(F.col("begin_date").isNotNull(), "windows").otherwise(F.col("window_id"))
    return _window_rows(spark, sf).groupBy(part.alias("part")).agg(F.sum("row_count").alias("row_count"))


@query(
    f"""{SRC} SELECT kind, CAST(o_orderkey AS VARCHAR) AS value, o_totalprice
FROM src, (VALUES ('batched'), ('batches')) v(kind)
UNION ALL SELECT kind, 'Full ' || schedule || ' 1998-06-14 04:00:00 ' || (SELECT count(*) FROM src), NULL
FROM (VALUES ('batched', 'false'), ('batches', 'Batches')) v(kind, schedule)"""
)
def batched_flow_undated(spark, sf):
    """Sources whose update dates are all missing: targets, stamps and schedules stay as they were."""
    src = fx.src_orders(spark, sf)
    undated = src.withColumn("last_update_date", F.lit(None).cast("timestamp_ntz"))
    items = [
        {"table_uid": kind, "source_table": kind, "load_type": "Full", **more}
        for kind, more in (("batched", {"batched": "true"}), ("batches", {"schedule": "Batches"}))
    ]
    run = make_run(
        spark, sf, items, read={k: lambda: undated for k in ("batched", "batches")},
        window_cost="row_count",
    )
    for kind in ("batched", "batches"):
        replace_load(src, f"{run.target_root}/dw/{kind}")
    runs.run_batched(run)
    runs.run_scheduled(run)
    rows = run.control().selectExpr(
        "table_uid AS kind",
        "concat_ws(' ', load_type, schedule, last_update_date, source_row_count) AS value",
        "CAST(NULL AS DOUBLE) AS o_totalprice",
    )
    for kind in ("batched", "batches"):
        held = read_target(spark, f"{run.target_root}/dw/{kind}")
        rows = rows.unionByName(
            held.selectExpr(f"'{kind}' AS kind", "CAST(o_orderkey AS STRING) AS value", "o_totalprice")
        )
    return rows


@query(
    f"""{SRC}, holes AS (SELECT o_orderkey FROM src WHERE o_orderkey % 3 = 0)
SELECT 'rows' AS state, CAST(o_orderkey AS VARCHAR) AS value FROM src
UNION ALL SELECT 'control', 'CDC ' || count(*) || ' ' || count(*) FROM src
UNION ALL SELECT 'undated', CAST(count(*) AS VARCHAR) FROM holes"""
)
def batched_flow_loads_remainder(spark, sf):
    """A third of the rows has no date; told to, the run loads them too and the counts agree."""
    src = fx.src_orders(spark, sf)
    holes = src.withColumn("last_update_date", F.expr("CASE WHEN o_orderkey % 3 <> 0 THEN last_update_date END"))
    run = make_run(
        spark, sf,
        [{"table_uid": "orders", "source_table": "holes", "load_type": "Full", "batched": "true"}],
        read={"holes": lambda: holes}, window_cost="row_count", remainder="load",
    )
    run = _after_the_data(run)
    runs.run_batched(run)
    control = run.control().selectExpr(
        "'control' AS state", "concat_ws(' ', load_type, source_row_count, target_row_count) AS value"
    )
    undated = read_target(spark, run.windows_path).where("window_id = 'undated'")
    return (
        read_target(spark, f"{run.target_root}/dw/holes")
        .selectExpr("'rows' AS state", "CAST(o_orderkey AS STRING) AS value")
        .unionByName(control)
        .unionByName(undated.selectExpr("'undated' AS state", "CAST(row_count AS STRING) AS value"))
    )


@query(
    f"""{SRC} SELECT 'rows' AS state, CAST(o_orderkey AS VARCHAR) AS value FROM src
UNION ALL SELECT 'control', 'CDC ' || count(*) FROM src
UNION ALL SELECT 'beyond the limit', '0'"""
)
def batched_flow_hot_day(spark, sf):
    """A third of the rows on one day: the day is cut into time ranges, and no window is beyond the limit."""
    src = fx.src_orders(spark, sf)
    hot = src.withColumn(
        "last_update_date",
        F.expr(
            "CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP_NTZ'1998-02-03 00:00:00'"
            " + make_dt_interval(0, 0, 0, pmod(hash(o_orderkey), 86400)) ELSE last_update_date END"
        ),
    )
    limit = src.count() // 20
    run = make_run(
        spark, sf,
        [{"table_uid": "orders", "source_table": "hot", "load_type": "Full", "batched": "true"}],
        read={"hot": lambda: hot}, window_cost="row_count", window_limit=limit,
    )
    run = _after_the_data(run)
    runs.run_batched(run)
    control = run.control().selectExpr("'control' AS state", "concat_ws(' ', load_type, target_row_count) AS value")
    status = read_target(spark, run.windows_path).where("begin_date IS NOT NULL")
    beyond = status.where(F.col("row_count") > limit).agg(F.count("*").cast("string").alias("value"))
    return (
        read_target(spark, f"{run.target_root}/dw/hot")
        .selectExpr("'rows' AS state", "CAST(o_orderkey AS STRING) AS value")
        .unionByName(control)
        .unionByName(beyond.select(F.lit("beyond the limit").alias("state"), "value"))
    )


@query(
    """SELECT o_orderkey AS table_uid, 'CDC' AS load_type,
  CASE WHEN o_orderkey % 3 = 0 THEN 'true' ELSE 'false' END AS schedule,
  CAST(o_custkey AS BIGINT) AS target_row_count,
  CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 5 END AS priority FROM orders"""
)
def control_fold(spark, sf):
    """A control row for each order: edits and results added out of order, twice, and an older result last."""
    orders = fx.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("table_uid"), "o_custkey")
    key = F.col("table_uid").cast("bigint")
    fields = CONTROL.fieldNames()
    defined = orders.select(
        "table_uid", F.lit("src").alias("source_table"), F.lit("Full").alias("load_type"),
        F.lit("Batches").alias("schedule"), F.lit(5).alias("priority"),
    )
    def result(at, rows, load_type):
        return orders.select(
            "table_uid", F.lit(load_type).alias("load_type"), F.lit("loaded").alias("outcome"),
            rows.cast("bigint").alias("source_count"), rows.cast("bigint").alias("rows_after"),
            F.lit(0).cast("bigint").alias("rows_before"), F.lit(0).cast("bigint").alias("processed"),
            F.lit(False).alias("load_error"), F.lit("").alias("load_error_message"),
            F.lit("").alias("extract_error"), F.lit(True).alias("promote"), F.lit(at).alias("finished_at"),
            F.lit(None).cast("string").alias("min_update_date"), F.lit(None).cast("string").alias("max_update_date"),
            F.lit("").alias("prior_update_date"), F.lit(False).alias("count_failed"), F.lit(True).alias("scheduled"),
        )

    late, early = result("1998-06-15 05:00:00", F.col("o_custkey"), "Full"), result("1998-06-14 05:00:00", key, "CDC")
    again = orders.where(key % 3 == 0).select("table_uid", F.lit("true").alias("schedule"))
    first = orders.where(key % 4 == 0).select("table_uid", F.lit(1).alias("priority"))
    facts = [
        R.result_facts(late),
        R.as_facts(again, ["schedule"], F.lit("1998-06-15 06:00:00"), True),
        R.as_facts(defined, fields, F.lit(""), True),
        R.result_facts(late),
        R.as_facts(first, ["priority"], F.lit("1998-06-01 00:00:00"), True),
        R.result_facts(early),
    ]
    folded = R.fold_control(reduce(lambda a, b: a.unionByName(b), facts))
    return folded.select(key.alias("table_uid"), "load_type", "schedule", "target_row_count", "priority")


def _fails_once(frame):
    """A source that cannot be read the first time it is asked for."""
    asked = []

    def read():
        asked.append(1)
        if len(asked) == 1:
            raise OSError("source not reached")
        return frame

    return read


@query(
    f"""{SRC} SELECT 'rows' AS state, CAST(o_orderkey AS VARCHAR) AS value, o_totalprice FROM src
UNION ALL SELECT 'control', 'Full true 1998-06-14 04:00:00 0', NULL FROM (VALUES (1)) v(x)"""
)
def scheduled_flow_count_failed(spark, sf):
    """A source whose count fails: the target and the control row stay as they were."""
    src = fx.src_orders(spark, sf)
    run = make_run(
        spark,
        sf,
        [{"table_uid": "orders", "source_table": "orders_src", "load_type": "Full",
          "schedule": "true"}],
        read={"orders_src": _fails_once(src)},
    )
    target = f"{run.target_root}/dw/orders_src"
    replace_load(src, target)
    runs.run_scheduled(run)
    after = run.control().selectExpr(
        "'control' AS state",
        "concat_ws(' ', load_type, schedule, last_update_date, source_row_count) AS value",
        "CAST(NULL AS DOUBLE) AS o_totalprice",
    )
    return read_target(spark, target).selectExpr(
        "'rows' AS state", "CAST(o_orderkey AS STRING) AS value", "o_totalprice"
    ).unionByName(after)


def _after_the_data(run):
    run.as_of = fx.DATA_END
    run.clock = lambda: datetime(fx.DATA_END.year, fx.DATA_END.month, fx.DATA_END.day, 4, 5, 6)
    return run


_WHOLE = f"""{SRC}, n AS (SELECT count(*) AS c FROM src)
SELECT 'rows' AS state, CAST(o_orderkey AS VARCHAR) AS value, o_totalprice FROM src
UNION ALL SELECT 'control', 'CDC false ' || c || ' ' || c, NULL FROM n"""


def _rows_and_control(spark, run):
    after = run.control().selectExpr(
        "'control' AS state",
        "concat_ws(' ', load_type, schedule, source_row_count, target_row_count) AS value",
        "CAST(NULL AS DOUBLE) AS o_totalprice",
    )
    return read_target(spark, f"{run.target_root}/dw/orders_src").selectExpr(
        "'rows' AS state", "CAST(o_orderkey AS STRING) AS value", "o_totalprice"
    ).unionByName(after)


@query(_WHOLE)
def batched_full_flow_whole(spark, sf):
    """A split load that ends after the data: every row loads and the table is promoted."""
    items = [{"table_uid": "orders", "source_table": "orders_src", "load_type": "Full",
              "batched": "true"}]
    run = _after_the_data(make_run(spark, sf, items, window_limit=1_000_000))
    runs.run_batched(run)
    return _rows_and_control(spark, run)


@query(_WHOLE)
def scheduled_batches_flow(spark, sf):
    """The same by months, as its schedule asks."""
    items = [{"table_uid": "orders", "source_table": "orders_src", "load_type": "Full",
              "schedule": "Batches"}]
    run = _after_the_data(make_run(spark, sf, items))
    runs.run_scheduled(run)
    return _rows_and_control(spark, run)


@query(
    f"""{SRC} SELECT src.o_orderkey, src.o_totalprice FROM src
WHERE CAST(last_update_date AS DATE) < DATE '1998-02-10'
UNION ALL SELECT o_orderkey, o_totalprice FROM src
WHERE CAST(last_update_date AS DATE) BETWEEN DATE '1998-02-01' AND DATE '1998-03-05'"""
)
def scheduled_manual_append_flow(spark, sf):
    """A manual range without truncation adds its rows to what is there."""
    run = make_run(
        spark,
        sf,
        [{"table_uid": "part", "source_table": "orders_src", "load_type": "Special_Full",
          "return_fields": "o_orderkey, o_totalprice", "schedule": "Manual",
          "schedule_truncate": "false", "schedule_begin": "1998-02-01",
          "schedule_end": "1998-03-05"}],
    )
    target = f"{run.target_root}/dw/orders_src"
    before = fx.src_orders(spark, sf).filter(F.to_date("last_update_date") < "1998-02-10")
    replace_load(before.select("o_orderkey", "o_totalprice"), target)
    runs.run_scheduled(run)
    return read_target(spark, target)


@query(
    f"""{_COLUMNS} SELECT column_name, data_type, table_name || '/' || column_name AS place
FROM columns_ WHERE {_NAMED} AND data_type IS NOT NULL"""
)
def metadata_flow_upper_case(spark, sf):
    """A catalog with upper-case names and a fifth column asked for in the control row."""
    catalog = fx.catalog_columns(spark, sf)
    catalog = catalog.select(*[F.col(c).alias(c.upper()) for c in catalog.columns])
    run = make_run(
        spark,
        sf,
        [{"table_uid": "cols", "source_table": "catalog", "load_type": "MetaData_Cols",
          "return_fields": "OWNER, TABLE_NAME, COLUMN_NAME, DATA_TYPE, "
                           "concat(TABLE_NAME, '/', COLUMN_NAME) AS PLACE",
          "has_update_date": "false"}],
        read={"catalog": lambda: catalog},
        owner=fx.OWNER,
        release="23C",
    )
    runs.run_metadata(run)
    loaded = read_target(spark, f"{run.target_root}/dw/catalog_All_23C")
    return loaded.select("column_name", "data_type", "place")


@query(
    f"""{SRC} SELECT 'manual' AS loaded, o_orderkey, o_totalprice FROM src
WHERE CAST(last_update_date AS DATE) BETWEEN DATE '1998-02-10' AND DATE '1998-03-05'
UNION ALL SELECT 'whole', o_orderkey, o_totalprice FROM src
UNION ALL SELECT 'whole:' || table_uid || ':' || schedule, NULL, NULL FROM
  (VALUES ('manual', 'false'), ('whole', 'false')) v(table_uid, schedule)""",
    as_text="o_orderkey",
)
def scheduled_flow(spark, sf):
    """Targets of a manual range and of a whole-table schedule, and the schedules after them."""
    fields = "o_orderkey, o_totalprice"
    run = make_run(
        spark,
        sf,
        [
            {"table_uid": "manual", "source_table": "orders_src", "load_type": "Special_Full",
             "return_fields": fields, "schedule": "Manual", "schedule_truncate": "true",
             "schedule_begin": "1998-02-10", "schedule_end": "1998-03-05",
             "target_schema": "part"},
            {"table_uid": "whole", "source_table": "orders_src", "load_type": "Special_Full",
             "return_fields": fields, "schedule": "true"},
        ],
    )
    runs.run_scheduled(run)
    part = read_target(spark, f"{run.target_root}/part/orders_src")
    whole = read_target(spark, f"{run.target_root}/dw/orders_src")
    after = run.control().select(
        F.concat_ws(":", F.lit("whole"), "table_uid", "schedule").alias("loaded"),
        F.lit(None).cast("bigint").alias("o_orderkey"),
        F.lit(None).cast("double").alias("o_totalprice"),
    )
    return (
        part.withColumn("loaded", F.lit("manual"))
        .unionByName(whole.withColumn("loaded", F.lit("whole")))
        .unionByName(after)
        .select("loaded", "o_orderkey", "o_totalprice")
    )


def _owned(catalog):
    """Odd orders belong to the owner whose columns are read."""
    return catalog.withColumn("owner", F.when(F.col("owner") == "1", fx.OWNER).otherwise("-"))


@query(
    f"""{_COLUMNS} SELECT 'columns' AS loaded, table_name, column_name
FROM columns_ WHERE {_NAMED} AND data_type IS NOT NULL
UNION ALL SELECT 'keys', table_name, column_name FROM ({PRIMARY_KEYS_SQL}) k"""
)
def metadata_flow(spark, sf):
    """Column catalog and primary keys, each into its release's table."""
    run = make_run(
        spark,
        sf,
        [
            {"table_uid": "cols", "source_table": "catalog", "load_type": "MetaData_Cols",
             "return_fields": "owner, table_name, column_name, data_type",
             "has_update_date": "false"},
            {"table_uid": "keys", "source_table": "primarykeys",
             "load_type": "MetaData_primarykeys"},
        ],
        read={
            "all_constraints": lambda: _owned(fx.constraints(spark, sf)),
            "all_cons_columns": lambda: _owned(fx.cons_columns(spark, sf)),
        },
        owner=fx.OWNER,
        release="23B",
    )
    runs.run_metadata(run)
    columns = read_target(spark, f"{run.target_root}/dw/catalog_All_23B")
    keys = read_target(spark, f"{run.target_root}/dw/primarykeys_All_23B")
    return (
        columns.select(F.lit("columns").alias("loaded"), "table_name", "column_name")
    ).unionByName(keys.select(F.lit("keys").alias("loaded"), "table_name", "column_name"))


@query(_FREEFORM)
def freeform_flow(spark, sf):
    names = ("customer", "nation", "region", "orders")
    run = make_run(
        spark,
        sf,
        [{"table_uid": "people", "source_table": "people", "load_type": "FreeForm",
          "created": "false", "freeform_sql": _FREEFORM, "freeform_truncate": "true"}],
        tables={n: fx.table(spark, sf, n) for n in names},
    )
    runs.run_freeform(run)
    return read_target(spark, f"{run.target_root}/dw/people")


@query(
    f"""{SRC}, n AS (SELECT count(*) AS c FROM src)
SELECT 'events_src' AS feed, 'Success' AS extract_status, 'Success - No rows returned' AS load_status,
  CAST(NULL AS VARCHAR) AS target_rows, '' AS load_start FROM n
UNION ALL SELECT 'missing', 'Failed', NULL, NULL, NULL FROM n
UNION ALL SELECT 'orders_src', 'Success', 'Success', CAST(c AS VARCHAR), '1998-06-15 04:05:06' FROM n"""
)
def run_statistics(spark, sf):
    """Statistics after a load, an empty extract and a source that cannot be read."""
    events = fx.src_events(spark, sf).withColumn("creation_date", F.col("last_update_date"))
    run = make_run(
        spark,
        sf,
        [
            {"table_uid": "a", "source_table": "orders_src", "load_type": "Full"},
            {"table_uid": "b", "source_table": "events_src", "load_type": "CDC",
             "primary_key": "event_id"},
            {"table_uid": "c", "source_table": "missing", "load_type": "Full"},
        ],
        read={"events_src": lambda: events},
    )
    runs.run_regular(run)
    return run.stats().select("feed", "extract_status", "load_status", "target_rows", "load_start")
