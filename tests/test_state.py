from __future__ import annotations

import pytest

from tidegate.operators import reconcile as R
from tidegate.schemas import CONTROL, LOAD_STATS, RUN_RESULT
from tidegate.session import small_frame
from tidegate.sources.landing import read_landing_csv

BASE = {
    "table_uid": "t",
    "load_type": "Full",
    "outcome": "loaded",
    "source_count": 10,
    "rows_before": 0,
    "rows_after": 10,
    "processed": 10,
    "load_error": False,
    "load_error_message": "",
    "extract_error": "",
    "promote": True,
    "prior_update_date": "2024-01-01 00:00:00",
    "finished_at": "2024-01-02 03:00:00",
}


def results(spark, *changes):
    return small_frame(spark, [{**BASE, **c} for c in changes], RUN_RESULT)


@pytest.mark.parametrize(
    "change, tally",
    [
        ({}, (10, 0)),
        ({"load_type": "CDC", "rows_before": 7, "rows_after": 9, "processed": 5}, (2, 3)),
        ({"load_type": "Special_CDC", "rows_before": 9, "rows_after": 9, "processed": 5}, (0, 5)),
        ({"load_type": "FreeForm", "rows_before": 9, "rows_after": 12}, (12, 0)),
    ],
)
def test_tally(spark, change, tally):
    row = R.load_tally(results(spark, change)).first()
    assert (row.inserted_rows, row.updated_rows) == tally


@pytest.mark.parametrize(
    "change, after",
    [
        ({}, "CDC"),
        ({"load_type": "Special_Full"}, "Special_CDC"),
        ({"promote": False}, "Full"),
        ({"rows_after": 9}, "Full"),
        ({"load_error": True}, "Full"),
        ({"load_type": "CDC"}, "CDC"),
        ({"load_type": "Validation"}, "Validation"),
        ({"load_type": "MetaData_Cols"}, "MetaData_Cols"),
        ({"load_type": "FreeForm"}, "FreeForm"),
    ],
)
def test_next_type(spark, change, after):
    assert R.next_load_type(results(spark, change)).first().next_load_type == after


def test_next_type_variants(spark):
    rows = results(spark, {"promote": False}, {"load_type": "Special_Full", "table_uid": "s"})
    forced = {r.table_uid: r.next_load_type for r in R.next_load_type(rows, True, ["Full"]).collect()}
    assert forced == {"t": "CDC", "s": "Special_Full"}
    sub = R.next_load_type_subbatch(results(spark, {}, {"rows_after": 9}))
    assert [r.next_load_type for r in sub.collect()] == ["CDC", "Full"]


def test_watermark_and_difference(spark):
    rows = R.advance_watermark(results(spark, {}, {"load_error": True})).collect()
    assert [r.next_update_date for r in rows] == [BASE["finished_at"], BASE["prior_update_date"]]
    assert R.count_difference(results(spark, {"rows_after": 4})).first().count_difference == 6


@pytest.fixture
def control(spark):
    item = {
        "load_type": "Full",
        "schedule": "true",
        "last_update_date": "2024-01-01 00:00:00",
        "min_update_date": "2020-01-01",
        "inserted_rows": 5,
        "load_error": False,
    }
    return small_frame(
        spark, [{"table_uid": "t", **item}, {"table_uid": "other", **item}], CONTROL
    )


def changed(before, after):
    """Fields of row t that differ, after checking that the other row is as it was."""
    old = {r.table_uid: r.asDict() for r in before.collect()}
    new = {r.table_uid: r.asDict() for r in after.collect()}
    assert set(old) == set(new) and old["other"] == new["other"]
    assert after.schema.fieldNames() == before.schema.fieldNames()
    return {k: v for k, v in new["t"].items() if v != old["t"][k]}


def test_success_writes_nulls_too(spark, control):
    got = changed(control, R.apply_success(control, R.settle(results(spark, {}))))
    assert got["load_type"] == "CDC" and got["last_update_date"] == BASE["finished_at"]
    assert got["min_update_date"] is None and got["inserted_rows"] == 10
    assert got["created"] is True and "schedule" not in got


def test_a_failed_load_keeps_stamp_and_type(spark, control):
    bad = results(spark, {"load_error": True, "load_error_message": "boom", "rows_after": 0})
    got = changed(control, R.apply_success(control, R.settle(bad)))
    assert got["load_error"] is True and got["load_error_message"] == "boom"
    assert "last_update_date" not in got and "load_type" not in got


def test_zero_rows_change_two_fields(spark, control):
    got = changed(control, R.apply_zero_rows(control, results(spark, {})))
    assert got == {"last_update_date": BASE["finished_at"], "zero_rows": True}


def test_extract_failure_keeps_the_stamp(spark, control):
    failed = results(spark, {"extract_error": "gone", "outcome": "extract_failed"})
    got = changed(control, R.apply_extract_failure(control, failed))
    assert got["extract_error"] == "gone" and got["source_row_count"] == 10
    assert got["inserted_rows"] == 0 and "last_update_date" not in got and "load_type" not in got


def test_schedule_is_cleared_only_on_success(spark, control):
    got = changed(control, R.apply_schedule_done(control, R.settle(results(spark, {}))))
    assert got["schedule"] == "false" and got["inserted_rows"] is None
    bad = R.settle(results(spark, {"load_error": True}))
    got = changed(control, R.apply_schedule_done(control, bad))
    assert "schedule" not in got and "last_update_date" not in got and got["load_error"] is True


def test_batch_progress_leaves_tallies(spark, control):
    got = changed(control, R.apply_batch_progress(control, R.settle(results(spark, {}))))
    assert "inserted_rows" not in got and got["target_row_count"] == 10


def stats_rows(spark, *names, **fields):
    return small_frame(spark, [{"file_name": n, **fields} for n in names], LOAD_STATS)


def outcome(spark, name, **fields):
    base = {
        "file_name": name,
        "outcome": "loaded",
        "target_rows": 9,
        "inserted_rows": 2,
        "updated_rows": 3,
        "load_error": False,
        "load_error_message": "",
        "extract_error": "",
        "extract_end": "e",
        "load_end": "l",
    }
    return {**base, **fields}


def test_put_if_absent(spark):
    known = stats_rows(spark, "a", extract_status="Success", feed="kept")
    new = stats_rows(spark, "a", "b", "b", feed="new", extract_start="1")
    got = {r.file_name: r for r in R.stats_put_if_absent(known, new).collect()}
    assert set(got) == {"a", "b"} and got["a"].feed == "kept"
    assert got["a"].extract_status == "Success" and got["b"].extract_status == "In Progress"
    assert R.stats_put_if_absent(known, new).count() == 2


def test_transitions(spark):
    from pyspark.sql import Row

    stats = stats_rows(spark, "ok", "bad", "none", "gone", "open", extract_status="In Progress")
    outcomes = spark.createDataFrame(
        [
            Row(**outcome(spark, "ok")),
            Row(**outcome(spark, "bad", load_error=True, load_error_message="boom")),
            Row(**outcome(spark, "none", outcome="empty")),
            Row(**outcome(spark, "gone", outcome="extract_failed", extract_error="no source")),
        ]
    )
    got = {r.file_name: r for r in R.stats_transition(stats, outcomes).collect()}
    assert (got["ok"].extract_status, got["ok"].load_status) == ("Success", "Success")
    assert (got["ok"].processed_rows, got["ok"].target_rows, got["ok"].load_end) == ("5", "9", "l")
    assert (got["bad"].load_status, got["bad"].load_failure) == ("Failed", "boom")
    assert got["none"].load_status == "Success - No rows returned"
    assert got["none"].target_rows is None and got["none"].load_start == ""
    assert (got["gone"].extract_status, got["gone"].extract_failure) == ("Failed", "no source")
    assert got["gone"].load_status is None
    assert got["open"].extract_status == "In Progress" and got["open"].extract_end is None


def test_exports(spark, control, tmp_path):
    ready = small_frame(
        spark,
        [
            {"table_uid": str(i), "frequency": "Daily", "active": True, "created": True,
             "priority": i % 3, "sort_order": i, "freeform_sql": 'SELECT "a,b"\nFROM t'}
            for i in range(20)
        ],
        CONTROL,
    )
    R.export_control_snapshot(ready, str(tmp_path / "control"), priority=1)
    back = read_landing_csv(spark, str(tmp_path / "control"))
    assert [r.table_uid for r in back.collect()] == ["1", "4", "7", "10", "13", "16", "19"]
    assert back.first().freeform_sql == 'SELECT "a,b"\nFROM t' and back.first().active == "true"
    stats = stats_rows(spark, "a", "b", feed="x")
    R.export_stats_item(stats, "b", str(tmp_path / "stats"))
    assert read_landing_csv(spark, str(tmp_path / "stats")).first().file_name == "b"
