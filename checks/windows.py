"""Date windows, profiles over them, and one-pass window assignment."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from checks.sources import DAY_PROFILE_SQL, SRC
from tidegate.functions.clean import empty_flag
from tidegate.operators import counts as C
from tidegate.operators import joins as J
from tidegate.operators import reconcile as R
from tidegate.operators import windows as win
from tidegate.operators.slices import date_range
from tidegate.session import work_path

# calendar pieces in SQL ------------------------------------------------------------------------

_MONTHS = f"""{SRC}, months AS (
  SELECT strftime(m, 'M%Y%m%d') AS window_id, 'month' AS grain, CAST(m AS DATE) AS begin_date,
    last_day(CAST(m AS DATE)) AS end_date
  FROM (SELECT unnest(generate_series(date_trunc('month', min(last_update_date))::TIMESTAMP,
      TIMESTAMP '1998-06-01', INTERVAL 1 MONTH)) AS m FROM src)),
days AS (SELECT begin_date AS month_, end_date AS month_end,
    CAST(unnest(generate_series(begin_date::TIMESTAMP, end_date::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day
  FROM months),
weeks AS (SELECT strftime(min(day), 'W%Y%m%d') AS window_id, 'week' AS grain,
    min(day) AS begin_date, max(day) AS end_date
  FROM days GROUP BY month_, date_trunc('week', day))"""


def _months(spark, sf):
    return win.month_windows(C.record_counts(fx.src_orders(spark, sf)), fx.AS_OF)


@query(f"{_MONTHS} SELECT * FROM months", as_text="begin_date end_date")
def month_windows(spark, sf):
    return _months(spark, sf)


@query(f"{_MONTHS} SELECT * FROM weeks", as_text="begin_date end_date")
def week_windows(spark, sf):
    return win.week_windows(_months(spark, sf))


@query(
    f"{_MONTHS} SELECT strftime(day, 'D%Y%m%d') AS window_id, 'day' AS grain, day AS begin_date,"
    " day AS end_date FROM days",
    as_text="begin_date end_date",
)
def day_windows(spark, sf):
    return win.day_windows(win.week_windows(_months(spark, sf)))


# one window list per customer segment, from the update dates of its orders
_SPANS = """SELECT c_custkey AS table_uid,
  CASE c_custkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'Full' WHEN 2 THEN 'Batches'
    WHEN 3 THEN 'Manual' ELSE 'false' END AS schedule,
  CASE WHEN c_custkey % 2 = 0 THEN DATE '1998-02-10' END AS schedule_begin,
  DATE '1998-03-05' AS schedule_end, min(o_orderdate) AS min_update_date,
  max(o_orderdate) AS max_update_date
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"""


@query(
    f"""WITH spans AS ({_SPANS}), batches AS (
  SELECT table_uid, unnest(generate_series(
      date_trunc('month', coalesce(min_update_date, TIMESTAMP '2022-09-01'))::TIMESTAMP,
      greatest(date_trunc('month', coalesce(min_update_date, TIMESTAMP '2022-09-01'))::TIMESTAMP,
               TIMESTAMP '1998-06-01'), INTERVAL 1 MONTH)) AS m
  FROM spans WHERE schedule = 'Batches'), ranges AS (
  SELECT table_uid, CAST(CASE WHEN schedule = 'Manual' THEN schedule_begin ELSE min_update_date END
      AS DATE) AS b, CAST(CASE WHEN schedule = 'Manual' THEN schedule_end ELSE max_update_date END
      AS DATE) AS e FROM spans WHERE schedule IN ('true', 'Full', 'Manual'))
SELECT table_uid, strftime(m, 'M%Y%m%d') AS window_id, 'month' AS grain, CAST(m AS DATE) AS begin_date,
  last_day(CAST(m AS DATE)) AS end_date FROM batches
UNION ALL
SELECT table_uid, strftime(b, 'R%Y%m%d'), 'range', b, e FROM ranges WHERE b <= e""",
    as_text="begin_date end_date",
)
def schedule_windows(spark, sf):
    spans = fx.run_sql(spark, sf, _SPANS, "customer", "orders")
    return win.schedule_windows(spans, fx.AS_OF)


# adaptive splitting ------------------------------------------------------------------------------

# rows per window of events: January is split, the later months are empty; at larger scales
# single days go beyond it too
EVENT_LIMIT = 2_000


def _adaptive_sql(limit: int) -> str:
    return f"""WITH months AS (
  SELECT CAST(m AS DATE) AS begin_date, last_day(CAST(m AS DATE)) AS end_date
  FROM (SELECT unnest(generate_series(date_trunc('month', min(ts))::TIMESTAMP,
      TIMESTAMP '2024-03-01', INTERVAL 1 MONTH)) AS m FROM events)),
days AS (SELECT begin_date AS month_,
    CAST(unnest(generate_series(begin_date::TIMESTAMP, end_date::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day
  FROM months),
sized AS (SELECT month_, d.day, greatest(month_, CAST(date_trunc('week', d.day) AS DATE)) AS week_,
    coalesce(row_count, 0) AS n
  FROM days d LEFT JOIN ({DAY_PROFILE_SQL}) p ON d.day = p.day),
summed AS (SELECT *, sum(n) OVER (PARTITION BY month_) AS nm,
    sum(n) OVER (PARTITION BY month_, week_) AS nw FROM sized),
chosen AS (SELECT day, n,
    CASE WHEN nm <= {limit} THEN 'month' WHEN nw <= {limit} THEN 'week' ELSE 'day' END AS grain,
    CASE WHEN nm <= {limit} THEN month_ WHEN nw <= {limit} THEN week_ ELSE day END AS begin_date
  FROM summed),
windows_ AS (SELECT concat(upper(grain[1:1]), strftime(begin_date, '%Y%m%d')) AS window_id, grain,
  begin_date, max(day) AS end_date, CAST(sum(n) AS BIGINT) AS cost, sum(n) > {limit} AS oversize
FROM chosen GROUP BY grain, begin_date)"""


def event_windows(spark, sf):
    """The chosen windows, written once as a run does before it extracts."""
    events = fx.src_events(spark, sf)
    months = win.month_windows(C.record_counts(events), fx.EVENTS_AS_OF)
    chosen = win.adaptive_windows(C.day_profile(events), months, EVENT_LIMIT)
    path = work_path(spark, "windows")
    chosen.write.parquet(path)
    return spark.read.schema(chosen.schema).parquet(path)


@query(f"{_adaptive_sql(EVENT_LIMIT)} SELECT * FROM windows_", as_text="begin_date end_date")
def adaptive_windows(spark, sf):
    return event_windows(spark, sf)


@query(
    f"{_adaptive_sql(EVENT_LIMIT)} SELECT e.event_id, e.ts AS last_update_date, e.user_id,"
    " e.event_type, e.value, e.props, w.window_id FROM events e JOIN windows_ w"
    " ON CAST(e.ts AS DATE) BETWEEN w.begin_date AND w.end_date"
)
def assign_adaptive_window(spark, sf):
    return J.assign_window(fx.src_events(spark, sf), event_windows(spark, sf))


@query(
    f"{_MONTHS} SELECT s.*, w.window_id FROM src s JOIN weeks w"
    " ON CAST(s.last_update_date AS DATE) BETWEEN w.begin_date AND w.end_date"
)
def assign_window(spark, sf):
    return J.assign_window(fx.src_orders(spark, sf), win.week_windows(_months(spark, sf)))


@query(
    f"{_MONTHS} SELECT w.window_id, count(*) AS row_count, min(l_shipdate) AS first_ship,"
    " max(l_shipdate) AS last_ship FROM lineitem JOIN months w"
    " ON CAST(l_shipdate AS DATE) BETWEEN w.begin_date AND w.end_date GROUP BY 1"
)
def assign_window_lineitem(spark, sf):
    rows = J.assign_window(fx.table(spark, sf, "lineitem"), _months(spark, sf), "l_shipdate")
    return rows.groupBy("window_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query(
    f"""{_MONTHS}, sizes AS (SELECT w.window_id, w.begin_date, w.end_date, count(o_orderkey) AS row_count
  FROM weeks w LEFT JOIN src ON CAST(last_update_date AS DATE) BETWEEN w.begin_date AND w.end_date
  GROUP BY 1, 2, 3)
SELECT *, CAST(sum(row_count) OVER (ORDER BY begin_date) AS BIGINT) AS target_row_count,
  row_count = 0 AS zero_rows FROM sizes""",
    as_text="begin_date end_date",
)
def window_progress(spark, sf):
    windows = win.week_windows(_months(spark, sf))
    return R.window_progress(J.assign_window(fx.src_orders(spark, sf), windows), windows)


@query(
    f"{SRC} SELECT * FROM src WHERE CAST(last_update_date AS DATE) BETWEEN DATE '1997-01-01'"
    " AND DATE '1997-02-28'"
)
def union_windows(spark, sf):
    src = fx.src_orders(spark, sf)
    return J.union_windows(
        date_range(src, date(1997, 1, 1), date(1997, 1, 31)),
        date_range(src, date(1997, 2, 1), date(1997, 2, 28)),
    )


@query(f"{SRC} SELECT count(*) = 0 AS zero_rows FROM src WHERE last_update_date >= '2030-01-01'")
def is_empty_extract(spark, sf):
    return empty_flag(
        fx.src_orders(spark, sf).filter(F.col("last_update_date") >= "2030-01-01")
    )
