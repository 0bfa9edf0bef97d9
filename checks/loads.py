"""Staging and loading: each query runs real loads in the shared folder and returns the target."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from checks.sources import _COLUMNS, _FREEFORM, _NAMED, CAUGHT_UP, ON_DAY, PRIMARY_KEYS_SQL, SRC
from checks.windows import _MONTHS, _months
from tidegate.operators.counts import record_counts_cdc
from tidegate.operators.joins import assign_window, upsert_rows
from tidegate.operators.reconcile import load_tally, next_load_type
from tidegate.operators.slices import cdc_day_slice
from tidegate.operators.windows import week_windows
from tidegate.plans import loads as L
from tidegate.session import work_path
from tidegate.sources.landing import read_landing_csv
from tidegate.sources.tables import scan_freeform
from tidegate.streaming.landing import landing_upsert_stream as start_stream

KEY = ["o_orderkey"]
NEWEST = ["last_update_date", "creation_date"]
BY_YEAR = "year(creation_date)"


def _target(spark):
    return work_path(spark, "target")


def _upserted_sql(day: str, slice_sql: str) -> str:
    return f"""{SRC}, tgt AS ({fx.tgt_orders_sql(day)}), staged AS (SELECT * FROM src WHERE {slice_sql})
SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM staged"""


def _staged_slice(spark, sf, since=None):
    """The change slice, staged as text and read back."""
    rows = cdc_day_slice(fx.src_orders(spark, sf), fx.AS_OF, since=since)
    path = L.stage_raw(rows, work_path(spark, "raw"), "CDC/orders/1998/06/15", "load")
    return L.read_staged(spark, path, rows.schema)


# staging ---------------------------------------------------------------------------------------


@query(
    f"""{_MONTHS} SELECT w.window_id, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus
FROM src JOIN weeks w ON CAST(last_update_date AS DATE) BETWEEN w.begin_date AND w.end_date"""
)
def stage_raw(spark, sf):
    """One folder per window; the window comes back from the folder name."""
    src = fx.src_orders(spark, sf).select("o_orderkey", "o_orderstatus", "last_update_date")
    rows = assign_window(src, week_windows(_months(spark, sf)))
    path = L.stage_raw(rows, work_path(spark, "raw"), "FullTableLoads/orders", "load", "window_id")
    columns = ["o_orderkey", "o_orderstatus", "last_update_date", "window_id"]
    return read_landing_csv(spark, path, columns).drop("last_update_date")


@query(
    f"""{SRC} SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'NA' ELSE CAST(o_orderkey AS VARCHAR) END
    || ',' || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderstatus END AS line FROM src"""
)
def stage_raw_text(spark, sf):
    """The lines of the staged files: cleaned text, but for the key column."""
    src = fx.src_orders(spark, sf).selectExpr(
        "CASE WHEN o_orderkey % 3 = 0 THEN 'NA' ELSE CAST(o_orderkey AS STRING) END AS k",
        "CASE WHEN o_orderkey % 5 = 0 THEN 'NaN' ELSE o_orderstatus END AS status",
    )
    path = L.stage_raw(src, work_path(spark, "raw"), "CDC/orders", "load", keys=["k"])
    return spark.read.text(path).toDF("line").filter("line <> 'k,status'")


# loading ---------------------------------------------------------------------------------------


@query(f"{SRC} SELECT * FROM src")
def replace_load(spark, sf):
    target = _target(spark)
    L.replace_load(fx.tgt_orders(spark, sf, "1998-06-14"), target)
    L.replace_load(fx.src_orders(spark, sf), target)
    return L.read_target(spark, target)


@query("SELECT * FROM lineitem")
def full_load_through_staging(spark, sf):
    """Extract, clean, stage as text, read back, load: every row of the largest table."""
    lines, target = fx.table(spark, sf, "lineitem"), _target(spark)
    path = L.stage_raw(lines, work_path(spark, "raw"), "FullTableLoads/lineitem", "load")
    L.replace_load(L.read_staged(spark, path, lines.schema), target)
    return L.read_target(spark, target)


@query(f"{SRC} {fx.tgt_orders_sql('1998-06-14')}")
def replace_load_without_rows(spark, sf):
    """An empty extract leaves the table as it was."""
    target = _target(spark)
    L.replace_load(fx.tgt_orders(spark, sf, "1998-06-14"), target)
    none = fx.src_orders(spark, sf).filter(F.col("last_update_date") > "2030-01-01")
    L.replace_load(none, target)
    return L.read_target(spark, target)


@query(
    f"{_MONTHS} SELECT src.* FROM src JOIN months w"
    " ON CAST(last_update_date AS DATE) BETWEEN w.begin_date AND w.end_date"
)
def windowed_replace_load(spark, sf):
    target = _target(spark)
    L.replace_load(fx.tgt_orders(spark, sf, "1998-06-14"), target)
    L.windowed_replace_load(fx.src_orders(spark, sf), _months(spark, sf), target)
    return L.read_target(spark, target)


@query(_upserted_sql("1998-06-14", ON_DAY))
def upsert_load(spark, sf):
    target = _target(spark)
    L.replace_load(fx.tgt_orders(spark, sf, "1998-06-14"), target)
    L.upsert_load(_staged_slice(spark, sf), target, KEY, NEWEST)
    return L.read_target(spark, target)


@query(_upserted_sql(str(fx.SINCE), CAUGHT_UP))
def upsert_load_by_piece(spark, sf):
    """Months of changes into a target cut by year of creation; untouched years are kept as files."""
    target = _target(spark)
    L.replace_load(fx.tgt_orders(spark, sf, str(fx.SINCE)), target, BY_YEAR)
    staged = _staged_slice(spark, sf, fx.SINCE)
    L.upsert_load(staged, target, KEY, NEWEST)
    L.upsert_load(staged, target, KEY, NEWEST)  # loading it twice changes nothing
    return L.read_target(spark, target)


@query(_upserted_sql(str(fx.SINCE), CAUGHT_UP))
def upsert_rows_only(spark, sf):
    """The same as one lazy plan, without a table."""
    staged = cdc_day_slice(fx.src_orders(spark, sf), fx.AS_OF, since=fx.SINCE)
    return upsert_rows(fx.tgt_orders(spark, sf, str(fx.SINCE)), staged, KEY)


@query(f"{SRC} {fx.tgt_orders_sql('1998-06-14')} UNION ALL SELECT * FROM src WHERE {ON_DAY}")
def append_load(spark, sf):
    target = _target(spark)
    L.replace_load(fx.tgt_orders(spark, sf, "1998-06-14"), target)
    L.append_load(_staged_slice(spark, sf), target)
    return L.read_target(spark, target)


@query(
    f"""{SRC}, n AS (SELECT (SELECT count(*) FROM ({fx.tgt_orders_sql('1998-06-14')}) t) AS before_,
  (SELECT count(*) FROM src WHERE {ON_DAY}) AS staged)
SELECT 'missing' AS state, false AS existed, CAST(0 AS BIGINT) AS rows_before FROM n
UNION ALL SELECT 'present', true, before_ FROM n"""
)
def create_if_missing(spark, sf):
    target, rows = _target(spark), fx.tgt_orders(spark, sf, "1998-06-14")
    first = L.create_if_missing(spark, target, rows.schema)
    L.append_load(rows, target)
    second = L.create_if_missing(spark, target, rows.schema)
    return spark.createDataFrame(
        [("missing", *first), ("present", *second)],
        "state string, existed boolean, rows_before bigint",
    )


@query(
    f"""{_COLUMNS}, n AS (SELECT count(*) AS c FROM columns_ WHERE {_NAMED} AND data_type IS NOT NULL)
SELECT 'missing' AS state, false AS existed, CAST(0 AS BIGINT) AS rows_before FROM n
UNION ALL SELECT 'present', true, c FROM n"""
)
def create_if_missing_metadata(spark, sf):
    target = _target(spark)
    first = L.create_if_missing_metadata(spark, target, "columns")
    L.metadata_cols_load(fx.catalog_columns(spark, sf), target, fx.OWNER, fx.TEXT_TYPE)
    second = L.create_if_missing_metadata(spark, target, "columns")
    return spark.createDataFrame(
        [("missing", *first), ("present", *second)],
        "state string, existed boolean, rows_before bigint",
    )


@query(_FREEFORM)
def freeform_load(spark, sf):
    target = _target(spark)
    names = ("customer", "nation", "region", "orders")
    found = scan_freeform(spark, _FREEFORM, {n: fx.table(spark, sf, n) for n in names})
    path = L.stage_raw(found, work_path(spark, "raw"), "FullTableLoads/freeform", "load")
    staged = L.read_staged(spark, path, found.schema)
    L.freeform_load(staged, target, truncate=False)
    L.freeform_load(staged, target, truncate=True)
    return L.read_target(spark, target)


@query(
    f"""{_COLUMNS} SELECT owner, table_name, column_name, data_type,
  CASE WHEN data_type = '{fx.TEXT_TYPE}' THEN 0 ELSE 1 END AS slice
FROM columns_ WHERE {_NAMED} AND data_type IS NOT NULL"""
)
def metadata_cols_load(spark, sf):
    target = _target(spark)
    L.metadata_cols_load(fx.catalog_columns(spark, sf), target, fx.OWNER, fx.TEXT_TYPE)
    return L.read_target(spark, target)


@query(PRIMARY_KEYS_SQL)
def metadata_primarykeys_load(spark, sf):
    target = _target(spark)
    L.create_if_missing_metadata(spark, target, "primary_keys")
    L.metadata_primarykeys_load(
        fx.constraints(spark, sf), fx.cons_columns(spark, sf), target, "1"
    )
    return L.read_target(spark, target)


@query(
    f"""{_COLUMNS} SELECT *, '23A' AS release FROM columns_ WHERE owner = '{fx.OWNER}'
UNION ALL SELECT *, '23B' FROM columns_ WHERE data_type IS NOT NULL"""
)
def release_snapshot(spark, sf):
    """A release loaded again replaces its own copy and no other."""
    target, columns = _target(spark), fx.catalog_columns(spark, sf)
    L.release_snapshot(columns.filter(F.col("owner") == fx.OWNER), target, "23A")
    L.release_snapshot(columns, target, "23B")
    L.release_snapshot(columns.filter(F.col("data_type").isNotNull()), target, "23B")
    return L.read_target(spark, target)


@query(_upserted_sql("1998-06-12", CAUGHT_UP.replace(str(fx.SINCE), "1998-06-12")))
def landing_upsert_stream(spark, sf):
    """Daily drops taken up by the stream: some after a restart, and one that comes late."""
    src, target, root = fx.src_orders(spark, sf), _target(spark), work_path(spark, "raw")
    L.replace_load(fx.tgt_orders(spark, sf, "1998-06-12"), target)
    checkpoint = work_path(spark, "stream")
    for back in (2, 1, 0):
        run_day = fx.AS_OF - timedelta(days=back)
        L.stage_raw(
            cdc_day_slice(src, run_day), root, f"CDC/orders/{run_day:%Y/%m/%d}", f"load_{back}"
        )
        if back < 2:
            _stream(spark, root, target, src.schema, checkpoint)
    # a drop of an earlier day arrives last, with what its rows were then
    late = fx.AS_OF - timedelta(days=2)
    old = cdc_day_slice(src, fx.AS_OF).selectExpr(
        "* EXCEPT (o_totalprice, last_update_date)",
        "o_totalprice - 5 AS o_totalprice",
        "last_update_date - INTERVAL 3 DAYS AS last_update_date",
    ).select(src.columns)
    L.stage_raw(old, root, f"CDC/orders/{late:%Y/%m/%d}", "late")
    _stream(spark, root, target, src.schema, checkpoint)
    return L.read_target(spark, target)


def _stream(spark, root, target, schema, checkpoint):
    started = start_stream(spark, root, target, schema, KEY, checkpoint, NEWEST)
    started.awaitTermination()
    if started.exception() is not None:
        raise started.exception()


# count, slice, stage, read back, upsert, tally, promote -----------------------------------------


@query(
    f"""{SRC}, tgt AS ({fx.tgt_orders_sql(str(fx.SINCE))}), staged AS (SELECT * FROM src WHERE {CAUGHT_UP}),
n AS (SELECT (SELECT count(*) FROM src WHERE CAST(last_update_date AS DATE) <= DATE '1998-06-14'
      OR CAST(creation_date AS DATE) <= DATE '1998-06-14') AS source_count,
  (SELECT count(*) FROM tgt) AS rows_before, (SELECT count(*) FROM staged) AS processed,
  (SELECT count(*) FROM staged WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)) AS added)
SELECT 'orders' AS table_uid, 'CDC' AS load_type, source_count, rows_before,
  rows_before + added AS rows_after, processed, added AS inserted_rows,
  processed - added AS updated_rows, 'CDC' AS next_load_type FROM n"""
)
def daily_change_load(spark, sf):
    src, target = fx.src_orders(spark, sf), _target(spark)
    L.replace_load(fx.tgt_orders(spark, sf, str(fx.SINCE)), target, BY_YEAR)
    done = L.upsert_load(_staged_slice(spark, sf, fx.SINCE), target, KEY, NEWEST)
    counted = record_counts_cdc(src, fx.AS_OF).select(
        F.lit("orders").alias("table_uid"),
        F.lit("CDC").alias("load_type"),
        F.col("row_count").alias("source_count"),
        F.lit(done.rows_before).cast("bigint").alias("rows_before"),
        F.lit(done.rows_after).cast("bigint").alias("rows_after"),
        F.lit(done.processed).cast("bigint").alias("processed"),
        F.lit(False).alias("load_error"),
        F.lit(True).alias("promote"),
    )
    return next_load_type(load_tally(counted)).drop("load_error", "promote")


@query(
    """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) + CASE WHEN o_orderkey % 2 = 1 THEN 0.5 ELSE 0 END
    AS amount, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority FROM orders""",
)
def grown_layout(spark, sf):
    """A target that gains a column and a wider type; its earlier files are read with them."""
    target, orders = _target(spark), fx.table(spark, sf, "orders")
    old = orders.where("o_orderkey % 2 = 0").selectExpr("o_orderkey", "CAST(o_custkey AS INT) AS amount")
    new = orders.where("o_orderkey % 2 = 1").selectExpr(
        "o_orderkey", "o_custkey + 0.5D AS amount", "o_orderpriority AS priority"
    )
    L.append_load(old, target)
    L.append_load(new, target)
    return L.read_target(spark, target)
