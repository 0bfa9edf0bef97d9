"""Null handling and date functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from tidegate.functions import clean as cl
from tidegate.functions import dates as D
from tidegate.functions.clean import NA_TOKENS

_SPELLED = (
    "CASE event_id % 23 "
    + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(NA_TOKENS))
    + " WHEN 19 THEN 'nullable' WHEN 20 THEN 'nannull' WHEN 21 THEN ' NA' ELSE event_type END"
)
_NOTES = f"SELECT event_id, {_SPELLED} AS note, props FROM events"
_TOKENS = ", ".join(f"'{t}'" for t in NA_TOKENS)


def _notes(spark, sf):
    return fx.run_sql(spark, sf, _NOTES, "events")


@query(
    f"SELECT event_id, CASE WHEN note NOT IN ({_TOKENS}) THEN note END AS note, props"
    f" FROM ({_NOTES}) n"
)
def na_tokens_to_null(spark, sf):
    return cl.na_tokens_to_null(_notes(spark, sf))


@query(
    f"SELECT event_id, CASE WHEN note IN ({_TOKENS}) THEN '' ELSE note END AS note, props"
    f" FROM ({_NOTES}) n"
)
def null_to_empty(spark, sf):
    return cl.null_to_empty(cl.na_tokens_to_null(_notes(spark, sf)))


@query(f"SELECT event_id, replace(note, 'null', '') AS note, props FROM ({_NOTES}) n")
def strip_null_text(spark, sf):
    return cl.strip_null_text(_notes(spark, sf))


@query(
    """SELECT doc_id, CASE WHEN lang NOT IN ('NA', 'fr') THEN lang END AS lang,
  replace(text, 'null', '') AS text FROM documents"""
)
def clean_documents(spark, sf):
    """Whole texts, with the caller's own list of missing spellings."""
    docs = fx.table(spark, sf, "documents").select("doc_id", "lang", "text")
    return cl.strip_null_text(cl.na_tokens_to_null(docs, ["lang"], ["NA", "fr"]), ["text"])


_COUNT_TEXT = """SELECT o_custkey AS table_uid,
  CASE WHEN o_custkey % 4 = 0 THEN 'nan' ELSE cast(count(*) AS string) END AS row_count,
  CASE WHEN o_custkey % 3 = 0 THEN 'null' ELSE cast(cast(min(o_orderdate) AS date) AS string) END
    AS min_update_date FROM orders GROUP BY o_custkey"""


@query(
    f"SELECT table_uid, nullif(row_count, 'nan') AS row_count,"
    f" nullif(min_update_date, 'null') AS min_update_date FROM ({_COUNT_TEXT}) c"
)
def clean_counts(spark, sf):
    return cl.clean_counts(fx.run_sql(spark, sf, _COUNT_TEXT, "orders"))


_STAMPS = """SELECT event_id, CASE event_id % 10 WHEN 0 THEN '' WHEN 1 THEN 'null'
  ELSE substring(cast(ts AS string), 1, 19) END AS stamp FROM events"""


@query(
    f"""SELECT event_id, stamp, TRY_CAST(substring(stamp, 1, 10) AS DATE) AS stamp_day,
  CAST(date_trunc('month', TRY_CAST(substring(stamp, 1, 10) AS DATE)) AS DATE) AS stamp_month
FROM ({_STAMPS}) s""",
    as_text="stamp_day stamp_month",
)
def date_part_of_stamp(spark, sf):
    stamps = fx.run_sql(spark, sf, _STAMPS, "events")
    return stamps.withColumns(
        {"stamp_day": D.stamp_day("stamp"), "stamp_month": D.stamp_month("stamp")}
    )


@query(
    """SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS hour,
  DATE '2024-01-20' AS parsed, CAST(ts AS DATE) >= DATE '2024-03-10' - 60 AS recent,
  upper(event_type) AS kind FROM events""",
    as_text="day parsed",
)
def sql_date_functions(spark, sf):
    return fx.table(spark, sf, "events").select(
        "event_id",
        D.trunc_day("ts").alias("day"),
        D.trunc_hour("ts").alias("hour"),
        D.parse_day(F.lit("20/01/2024"), "dd/MM/yyyy").alias("parsed"),
        (D.trunc_day("ts") >= D.days_before(fx.EVENTS_AS_OF, 60)).alias("recent"),
        D.upper("event_type").alias("kind"),
    )
