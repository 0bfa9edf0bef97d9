"""Physical plans: what reaches the scan, what is shuffled, what is broadcast."""

from __future__ import annotations

import re
from datetime import date
from pathlib import Path

import pytest

from checks import fixtures as fx
from tidegate.operators import counts as C
from tidegate.operators import joins as J
from tidegate.operators import slices as S
from tidegate.operators import windows as W

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def src(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "orders")
    fx.src_orders(spark, "/root/testdata/sf0.001").write.parquet(path)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def pushed(df) -> str:
    return " ".join(re.findall(r"PushedFilters: \[(.*)\]", plan(df)))


def test_slices_reach_the_scan(src):
    for df in (
        S.cdc_day_slice(src, fx.AS_OF),
        S.cdc_day_slice(src, fx.AS_OF, since=fx.SINCE),
        S.through_day(src, fx.AS_OF),
    ):
        assert pushed(df).startswith("Or(")
        assert "Exchange" not in plan(df)
    both = pushed(S.date_range(src, date(1998, 1, 1), date(1998, 1, 31)))
    assert "GreaterThanOrEqual(last_update_date" in both and "LessThan(last_update_date" in both


def test_counts_read_only_their_columns(src):
    assert "ReadSchema: struct<last_update_date:timestamp_ntz>" in plan(C.record_counts(src))
    assert "ReadSchema: struct<last_update_date:timestamp_ntz>" in plan(C.day_profile(src))


def test_windows_are_matched_without_moving_the_rows(src):
    months = W.month_windows(C.record_counts(src), fx.AS_OF)
    text = plan(J.assign_window(src, W.week_windows(months)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_span_reaches_the_scan(src):
    months = W.month_windows(C.record_counts(src), fx.AS_OF)
    df = J.assign_window(src, months, span=(date(1998, 2, 1), date(1998, 2, 28)))
    assert "LessThan(last_update_date,1998-03-01" in pushed(df)


def test_a_small_stage_moves_no_target_row(spark, src, tmp_path):
    S.cdc_day_slice(src, fx.AS_OF).write.parquet(str(tmp_path / "stage"))
    stage = spark.read.parquet(str(tmp_path / "stage"))
    text = plan(J.upsert_rows(src, stage, ["o_orderkey"]))
    assert "BroadcastHashJoin LeftAnti" in text and "hashpartitioning" not in text


def test_a_large_stage_is_shuffled_not_broadcast(spark, src):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(J.upsert_rows(src, src, ["o_orderkey"]))
        assert "SortMergeJoin LeftAnti" in text and "BroadcastHashJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nothing_is_forced():
    """No broadcast hints, local checkpoints, cross joins, Python functions or fixed partitions.

    The training-data operators send tables of proven size to every task; they have tests of their own.
    """
    files = [p for p in (ROOT / "tidegate").rglob("*.py") if "llm" not in p.parts]
    code = "\n".join(p.read_text() for p in files)
    for word in ("broadcast(", "localCheckpoint", "crossJoin", "udf(", "applyInPandas", "coalesce(1"):
        assert word not in code, word
