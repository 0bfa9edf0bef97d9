"""Scans, predicates, joins and counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from tidegate.operators import counts as C
from tidegate.operators import joins as J
from tidegate.operators import slices as S
from tidegate.plans.loads import read_staged, stage_raw
from tidegate.session import work_path
from tidegate.sources.catalogs import read_catalog_columns, read_primary_keys
from tidegate.sources.control import read_control
from tidegate.sources.landing import read_landing_csv
from tidegate.sources.tables import read_source, scan_freeform, scan_full, scan_projected

DAY = "1998-06-14"  # the day before AS_OF
SRC = f"WITH src AS ({fx.SRC_ORDERS_SQL})"
ON_DAY = f"CAST(last_update_date AS DATE) = DATE '{DAY}' OR CAST(creation_date AS DATE) = DATE '{DAY}'"
CAUGHT_UP = (
    f"CAST(last_update_date AS DATE) BETWEEN DATE '{fx.SINCE}' AND DATE '{DAY}'"
    f" OR CAST(creation_date AS DATE) BETWEEN DATE '{fx.SINCE}' AND DATE '{DAY}'"
)


# sources ---------------------------------------------------------------------------------------


@query(fx.CONTROL_SQL, name="read_control", as_text=fx.NULLABLE)
def control_items(spark, sf):
    path = work_path(spark, "control")
    fx.control_text(spark, sf).write.json(path)
    return read_control(spark, path)


@query("SELECT * FROM orders", name="scan_full")
def full(spark, sf):
    return scan_full(read_source(spark, "orders", sf))


_FIELDS = "l_orderkey, l_linenumber, concat(l_returnflag, l_linestatus) AS flags, l_shipdate"


@query(f"SELECT {_FIELDS} FROM lineitem", name="scan_projected")
def projected(spark, sf):
    return scan_projected(read_source(spark, "lineitem", sf), _FIELDS)


_FREEFORM = """SELECT DISTINCT c.c_custkey, n.n_name, r.r_name, o.o_orderstatus
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT OUTER JOIN orders o ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment = 'MACHINERY' AND r.r_name NOT IN ('ASIA') AND n.n_name IS NOT NULL"""


@query(_FREEFORM, name="scan_freeform")
def freeform(spark, sf):
    names = ("customer", "nation", "region", "orders")
    return scan_freeform(spark, _FREEFORM, {n: fx.table(spark, sf, n) for n in names})


@query(
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars"
    " FROM documents",
    name="read_landing_csv",
)
def landing_csv(spark, sf):
    root = work_path(spark, "raw")
    path = stage_raw(fx.table(spark, sf, "documents"), root, "docs", "load")
    return read_landing_csv(spark, path)


@query("SELECT * FROM events")
def landing_round_trip(spark, sf):
    """Numbers, times and quoted text survive staging and come back in their types."""
    events = fx.table(spark, sf, "events")
    path = stage_raw(events, work_path(spark, "raw"), "events", "load")
    return read_staged(spark, path, events.schema)


_COLUMNS = f"WITH columns_ AS ({fx.COLUMNS_SQL})"
_NAMED = f"owner = '{fx.OWNER}' AND table_name = upper(table_name)"


@query(
    f"""{_COLUMNS} SELECT table_name, column_name, data_type,
  CASE WHEN data_type = '{fx.TEXT_TYPE}' THEN 0 ELSE 1 END AS slice
FROM columns_ WHERE {_NAMED} AND data_type IS NOT NULL""",
    name="read_catalog_columns",
)
def catalog_both(spark, sf):
    return read_catalog_columns(
        fx.catalog_columns(spark, sf),
        fx.OWNER,
        return_fields="table_name, column_name, data_type, slice",
        text_type=fx.TEXT_TYPE,
    )


@query(f"{_COLUMNS} SELECT * FROM columns_ WHERE {_NAMED} AND data_type = '{fx.TEXT_TYPE}'")
def catalog_slice_text(spark, sf):
    return S.catalog_slice(fx.catalog_columns(spark, sf), fx.OWNER, 0, fx.TEXT_TYPE)


@query(f"{_COLUMNS} SELECT * FROM columns_ WHERE {_NAMED} AND data_type <> '{fx.TEXT_TYPE}'")
def catalog_slice_other(spark, sf):
    return S.catalog_slice(fx.catalog_columns(spark, sf), fx.OWNER, 1, fx.TEXT_TYPE)


@query(f"{_COLUMNS} SELECT * FROM columns_ WHERE owner = '{fx.OWNER}'")
def owner_filter(spark, sf):
    return S.owner_filter(fx.catalog_columns(spark, sf), fx.OWNER)


PRIMARY_KEYS_SQL = f"""SELECT cols.table_name, cols.column_name, cols.position, cons.status, cons.owner
FROM ({fx.CONSTRAINTS_SQL}) cons JOIN ({fx.CONS_COLUMNS_SQL}) cols
  ON cons.constraint_name = cols.constraint_name AND cons.owner = cols.owner
WHERE cons.constraint_type = 'P' AND cons.owner = '1'"""


@query(PRIMARY_KEYS_SQL)
def primary_keys(spark, sf):
    return J.primary_keys(fx.constraints(spark, sf), fx.cons_columns(spark, sf), "1")


@query(
    f"SELECT table_name, status, count(*) AS key_columns FROM ({PRIMARY_KEYS_SQL}) k GROUP BY 1, 2",
    name="read_primary_keys",
)
def keys_per_table(spark, sf):
    keys = read_primary_keys(fx.constraints(spark, sf), fx.cons_columns(spark, sf), "1")
    return keys.groupBy("table_name", "status").agg(F.count(F.lit(1)).alias("key_columns"))


# predicates ------------------------------------------------------------------------------------


@query(f"{SRC} SELECT * FROM src WHERE {ON_DAY}")
def cdc_day_slice(spark, sf):
    return S.cdc_day_slice(fx.src_orders(spark, sf), fx.AS_OF)


@query(f"{SRC} SELECT * FROM src WHERE {CAUGHT_UP}")
def cdc_catch_up_slice(spark, sf):
    return S.cdc_day_slice(fx.src_orders(spark, sf), fx.AS_OF, since=fx.SINCE)


@query(f"{SRC} SELECT o_orderkey, o_totalprice * 2 AS doubled FROM src WHERE {ON_DAY}")
def special_cdc_slice(spark, sf):
    return S.special_cdc_slice(
        fx.src_orders(spark, sf), "o_orderkey, o_totalprice * 2 AS doubled", fx.AS_OF
    )


THROUGH = (
    f"CAST(last_update_date AS DATE) <= DATE '{DAY}' OR CAST(creation_date AS DATE) <= DATE '{DAY}'"
)


@query(f"{SRC} SELECT * FROM src WHERE {THROUGH}")
def through_day(spark, sf):
    return S.through_day(fx.src_orders(spark, sf), fx.AS_OF)


@query(
    f"{SRC} SELECT * FROM src WHERE CAST(last_update_date AS DATE)"
    " BETWEEN DATE '1997-02-01' AND DATE '1997-02-28'"
)
def date_range(spark, sf):
    return S.date_range(fx.src_orders(spark, sf), date(1997, 2, 1), date(1997, 2, 28))


# counts ----------------------------------------------------------------------------------------

_COUNTS = (
    "count(*) AS row_count, min(last_update_date) AS min_update_date,"
    " max(last_update_date) AS max_update_date"
)


@query(f"{SRC} SELECT {_COUNTS} FROM src")
def record_counts(spark, sf):
    return C.record_counts(fx.src_orders(spark, sf))


@query(
    "SELECT count(*) AS row_count, CAST(NULL AS TIMESTAMP) AS min_update_date,"
    " CAST(NULL AS TIMESTAMP) AS max_update_date FROM lineitem"
)
def record_counts_no_lud(spark, sf):
    return C.record_counts_no_lud(fx.table(spark, sf, "lineitem"))


@query(
    f"{_COLUMNS} SELECT count(*) AS row_count, CAST(NULL AS TIMESTAMP) AS min_update_date,"
    f" CAST(NULL AS TIMESTAMP) AS max_update_date FROM columns_ WHERE owner = '{fx.OWNER}'"
)
def record_counts_one_owner(spark, sf):
    return C.record_counts_no_lud(fx.catalog_columns(spark, sf), fx.OWNER)


@query(f"{SRC} SELECT {_COUNTS} FROM src WHERE {THROUGH}")
def record_counts_cdc(spark, sf):
    return C.record_counts_cdc(fx.src_orders(spark, sf), fx.AS_OF)


# Count results as text, one per user; some are spelled missing, some are an error text.
_USER_COUNTS = """SELECT user_id,
  CASE WHEN user_id % 7 = 0 THEN 'table not found' WHEN user_id % 7 = 1 THEN 'nan'
       ELSE cast(count(*) AS string) END AS row_count,
  CASE WHEN user_id % 5 = 0 THEN 'null' ELSE cast(cast(min(ts) AS date) AS string) END
    AS min_update_date,
  CASE WHEN user_id % 5 = 1 THEN 'nan' ELSE cast(cast(max(ts) AS date) AS string) END
    AS max_update_date
FROM events GROUP BY user_id"""


@query(
    f"""SELECT user_id, CASE WHEN user_id % 7 IN (0, 1) THEN 0 ELSE CAST(row_count AS BIGINT) END
    AS row_count,
  CASE WHEN user_id % 7 NOT IN (0, 1) AND min_update_date <> 'null' THEN min_update_date END
    AS min_update_date,
  CASE WHEN user_id % 7 NOT IN (0, 1) AND max_update_date <> 'nan' THEN max_update_date END
    AS max_update_date
FROM ({_USER_COUNTS}) c"""
)
def counts_or_default(spark, sf):
    return C.counts_or_default(fx.run_sql(spark, sf, _USER_COUNTS, "events"), ["user_id"])


DAY_PROFILE_SQL = "SELECT CAST(ts AS DATE) AS day, count(*) AS row_count FROM events GROUP BY 1"


@query(f"{SRC} SELECT {_COUNTS} FROM src")
def profile_counts(spark, sf):
    """The source counts out of the day sizes, in the same pass."""
    return C.profile_counts(C.measure_days(fx.src_orders(spark, sf)))


@query(DAY_PROFILE_SQL, as_text="day")
def day_profile(spark, sf):
    return C.day_profile(fx.src_events(spark, sf))


@query(
    f"{SRC} SELECT CAST(last_update_date AS DATE) AS day, count(*) AS row_count FROM src"
    " GROUP BY 1 ORDER BY day",
    as_text="day",
)
def order_profile(spark, sf):
    return C.order_profile(C.day_profile(fx.src_orders(spark, sf)))


@query(
    """SELECT CAST(ts AS DATE) AS day, count(*) AS row_count,
  CAST(sum(strlen(concat_ws(',', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR),
           event_type, '"' || replace(props, '"', '""') || '"',
           CAST(CAST(value AS DECIMAL(18, 4)) AS VARCHAR),
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S'))) + 1) AS BIGINT) AS byte_count
FROM events GROUP BY 1""",
    as_text="day",
)
def day_profile_bytes(spark, sf):
    """All columns of events, in types that both engines write alike."""
    events = fx.src_events(spark, sf).selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "props",
        "CAST(value AS DECIMAL(18, 4)) AS value",
        "date_trunc('second', last_update_date) AS last_update_date",
    )
    return C.day_profile(events, with_bytes=True)



@query("SELECT date_trunc('hour', ts) AS hour, count(*) AS row_count FROM events GROUP BY 1")
def hour_profile(spark, sf):
    return C.hour_profile(fx.src_events(spark, sf))


@query(
    "SELECT date_trunc('hour', ts) AS hour, count(*) AS row_count FROM events"
    " WHERE CAST(ts AS DATE) = DATE '2024-01-09' GROUP BY 1"
)
def hour_profile_of_day(spark, sf):
    return C.hour_profile(fx.src_events(spark, sf), date(2024, 1, 9))


@query("SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark, sf):
    return C.distinct_rows(
        fx.table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey", "l_returnflag"]
    )


@query(f"{SRC} SELECT count(*) AS row_count FROM src WHERE {CAUGHT_UP}")
def extract_row_count(spark, sf):
    return C.extract_row_count(
        S.cdc_day_slice(fx.src_orders(spark, sf), fx.AS_OF, since=fx.SINCE)
    )


@query("SELECT count(CASE WHEN value < 5 THEN 1 END) AS undated_rows FROM events")
def undated_rows(spark, sf):
    return C.undated_rows(
        fx.src_events(spark, sf).withColumn(
            "last_update_date", F.when(F.col("value") >= 5, F.col("last_update_date"))
        )
    )


# joins -----------------------------------------------------------------------------------------


@query(
    f"""{SRC}, tgt AS ({fx.tgt_orders_sql(str(fx.SINCE))})
SELECT s.*, CASE WHEN t.o_orderkey IS NULL THEN 'insert' ELSE 'update' END AS action
FROM (SELECT * FROM src WHERE {CAUGHT_UP}) s LEFT JOIN tgt t ON s.o_orderkey = t.o_orderkey"""
)
def upsert_match(spark, sf):
    staged = S.cdc_day_slice(fx.src_orders(spark, sf), fx.AS_OF, since=fx.SINCE)
    return J.tag_staged(staged, fx.tgt_orders(spark, sf, str(fx.SINCE)), ["o_orderkey"])


@query(
    """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1"""
)
def keep_latest(spark, sf):
    return J.keep_latest(
        fx.table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"]
    )
