"""Content reconciliation and rows set aside."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.flows import make_run
from checks.registry import query
from checks.sources import SRC
from tidegate.operators import content
from tidegate.plans import flows as runs
from tidegate.plans import loads as L
from tidegate.session import work_path
from tidegate.sources.landing import read_landing_rows

_CHANGED = "o_orderkey % 397 = 5"


@query(
    f"""{SRC} SELECT strftime(last_update_date, '%Y-%m') AS month, count(*) AS source_rows,
  count(*) AS target_rows FROM src GROUP BY 1 HAVING count(CASE WHEN {_CHANGED} THEN 1 END) > 0"""
)
def differing_months(spark, sf):
    """Counts agree in every month; the months that hold a changed price are named."""
    src = fx.src_orders(spark, sf)
    target = src.withColumn(
        "o_totalprice", F.expr(f"CASE WHEN {_CHANGED} THEN o_totalprice + 1 ELSE o_totalprice END")
    )
    month = F.date_format("last_update_date", "yyyy-MM")
    odd = content.differing_groups(content.digests(src, month), content.digests(target, month))
    return odd.withColumnRenamed("group", "month")


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 91 = 3 AND l_linenumber <= 2")
def deleted_keys(spark, sf):
    """Lines that the source has lost, by a key of two columns."""
    lines = fx.table(spark, sf, "lineitem")
    source = lines.where("NOT (l_orderkey % 91 = 3 AND l_linenumber <= 2)")
    return content.deleted_keys(source, lines, ["l_orderkey", "l_linenumber"])


@query(
    f"""{SRC} SELECT 'Full' AS load_type, count(*) AS target_row_count FROM src
UNION ALL SELECT 'CDC', count(*) FROM src"""
)
def promotion_needs_equal_content(spark, sf):
    """Two full loads whose counts agree; one source changes a value after it was extracted."""
    src = fx.src_orders(spark, sf)
    later = src.withColumn(
        "o_totalprice", F.expr(f"CASE WHEN {_CHANGED} THEN o_totalprice + 1 ELSE o_totalprice END")
    )
    asked = []

    def moving():
        asked.append(1)
        return src if len(asked) <= 2 else later  # counted, extracted, then compared

    run = make_run(
        spark, sf,
        [{"table_uid": t, "source_table": t, "load_type": "Full"} for t in ("still", "moving")],
        read={"still": lambda: src, "moving": moving}, compare_content=True,
    )
    runs.run_regular(run)
    return run.control().select("load_type", "target_row_count")


_UNFIT, _SHORT, _LONG = "o_orderkey % 50 = 1", "o_orderkey % 50 = 2", "o_orderkey % 50 = 3"


@query(
    f"""SELECT 'loaded' AS reason, count(*) AS n FROM orders
WHERE NOT ({_UNFIT}) AND NOT ({_SHORT}) AND NOT ({_LONG})
UNION ALL SELECT 'broken row', count(*) FROM orders WHERE {_SHORT} OR {_LONG}
UNION ALL SELECT 'o_totalprice is not double', count(*) FROM orders WHERE {_UNFIT}"""
)
def landing_rows_set_aside(spark, sf):
    """A drop with rows of too few and too many fields and with prices that are no numbers."""
    orders = fx.table(spark, sf, "orders").selectExpr("o_orderkey", "o_totalprice", "o_orderstatus")
    lines = orders.select(
        F.expr(
            f"CASE WHEN {_UNFIT} THEN concat(o_orderkey, ',about ten,', o_orderstatus)"
            f" WHEN {_SHORT} THEN CAST(o_orderkey AS STRING)"
            f" WHEN {_LONG} THEN concat(o_orderkey, ',', o_totalprice, ',', o_orderstatus, ',x,y')"
            " ELSE concat(o_orderkey, ',', o_totalprice, ',', o_orderstatus) END"
        ).alias("value")
    )
    root = work_path(spark, "drop")
    lines.write.text(f"{root}/drop")
    text = read_landing_rows(spark, f"{root}/drop", orders.columns, header="false")
    good, _ = L.set_aside(text, orders.schema, f"{root}/aside")
    L.append_load(good, f"{root}/target")
    aside = spark.read.schema(L.ASIDE).json(f"{root}/aside")
    loaded = L.read_target(spark, f"{root}/target").select(F.lit("loaded").alias("reason"))
    return loaded.unionByName(aside.select("reason")).groupBy("reason").agg(F.count("*").alias("n"))
