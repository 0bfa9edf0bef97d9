from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.flows import make_run
from tidegate.plans import flows
from tidegate.plans.loads import read_target, replace_load
from tidegate.plans.tables import Target
from tidegate.sources.landing import read_landing_csv


def uid_rows(df):
    return {r.table_uid: r for r in df.collect()}


def items(*kinds, **shared):
    return [
        {"table_uid": f"t{i}", "source_table": "orders_src", "load_type": k,
         "primary_key": "o_orderkey", "return_fields": "o_orderkey, last_update_date",
         "validation_table": f"chk_{i}", "target_schema": f"s{i}", **shared}
        for i, k in enumerate(kinds)
    ]


@pytest.mark.parametrize("parallel", [1, 3])
def test_a_whole_run(spark, sf, parallel, tmp_path):
    run = make_run(
        spark, sf, items("Full", "CDC", "Validation", "Special_Full", "Special_CDC"),
        parallel=parallel,
    )
    done = flows.run_all(run, export_to=str(tmp_path / "export"))
    assert {d["table_uid"]: d["outcome"] for d in done} == {f"t{i}": "loaded" for i in range(5)}
    control = uid_rows(run.control())
    total = fx.src_orders(spark, sf).count()
    assert [control[f"t{i}"].load_type for i in range(5)] == [
        "CDC", "CDC", "Validation", "Special_CDC", "Special_CDC",
    ]
    assert control["t0"].target_row_count == control["t2"].target_row_count == total
    assert control["t1"].inserted_rows == control["t1"].target_row_count > 0
    assert run.stats().filter("load_status = 'Success'").count() == 5
    # everything ran today: a second run has nothing to do
    assert flows.run_all(run) == []


def test_after_promotion_the_next_day_loads_changes(spark, sf):
    run = make_run(spark, sf, items("Full"))
    flows.run_regular(run)
    run.as_of += timedelta(days=1)
    run.clock = lambda: datetime(1998, 6, 16, 1, 0, 0)
    (done,) = flows.run_regular(run)
    assert done["load_type"] == "CDC" and done["processed"] > 0
    assert done["rows_after"] == done["rows_before"]  # the full load had those rows already
    row = run.control().first()
    assert (row.inserted_rows, row.updated_rows) == (0, done["processed"])


def test_targets_are_cut_as_declared_whatever_their_size(spark, sf):
    by_month = "date_format(creation_date, 'yyyyMM')"
    run = make_run(spark, sf, items("Full"), pieces={"*": by_month})
    flows.run_regular(run)
    def files():
        found = Path(f"{run.target_root}/s0/orders_src").glob("__piece=*/*.parquet")
        return {(f.parent.name.split("=")[1], f.name) for f in found}

    before = files()
    months = fx.src_orders(spark, sf).selectExpr("date_format(creation_date, 'yyyyMM')").distinct()
    assert {f[0] for f in before} == {r[0] for r in months.collect()}
    run.as_of += timedelta(days=1)
    run.clock = lambda: datetime(1998, 6, 16, 1, 0, 0)
    flows.run_regular(run)
    after = files()
    # the day's changes rewrite the months they were created in, and no other
    assert {f[0] for f in after - before} <= {"199805", "199806"}
    assert {f[0] for f in before - after} <= {"199805", "199806"}
    plain = make_run(spark, sf, items("Full"))
    flows.run_regular(plain)
    assert Target(spark, f"{plain.target_root}/s0/orders_src").layout().piece_by is None
    # a table without the column stays whole
    lines = {"table_uid": "l", "source_table": "lineitem", "load_type": "Full",
             "has_update_date": "false"}
    other = make_run(spark, sf, [lines], pieces={"*": by_month})
    flows.run_regular(other)
    assert Target(spark, f"{other.target_root}/dw/lineitem").layout().piece_by is None


def failing(times, frame):
    """A source that cannot be read the first times it is asked for."""
    left = [times]

    def read():
        if left[0]:
            left[0] -= 1
            raise OSError("source not reached")
        return frame

    return read


@pytest.mark.parametrize("kind", ["scheduled", "batches", "batched"])
def test_a_failed_count_never_empties_cuts_or_promotes(spark, sf, kind):
    src = fx.src_orders(spark, sf)
    settings = {
        "scheduled": {"schedule": "true"},
        "batches": {"schedule": "Batches"},
        "batched": {"batched": "true"},
    }[kind]
    run = make_run(
        spark, sf, items("Full", **settings), read={"orders_src": failing(1, src)},
        window_cost="row_count",
    )
    target = f"{run.target_root}/s0/orders_src"
    replace_load(src, target)
    before = run.control().first()
    flow = flows.run_batched if kind == "batched" else flows.run_scheduled
    (done,) = flow(run)
    assert done["outcome"] == "extract_failed" and done["count_failed"]
    assert read_target(spark, target).count() == src.count()
    row = run.control().first()
    assert (row.load_type, row.schedule) == ("Full", before.schedule)
    assert row.last_update_date == before.last_update_date
    assert "could not be counted" in row.extract_error
    (again,) = flow(run)  # and the next run loads it
    assert again["outcome"] == "loaded"


def test_a_failed_count_lets_other_loads_go_on_without_promotion(spark, sf):
    src = fx.src_orders(spark, sf)
    empty = src.filter("o_orderkey < 0")
    run = make_run(
        spark,
        sf,
        [
            {"table_uid": "a", "source_table": "a", "load_type": "Full"},
            {"table_uid": "b", "source_table": "b", "load_type": "Full"},
        ],
        read={"a": failing(1, src), "b": failing(1, empty)},
    )
    done = {d["table_uid"]: d for d in flows.run_regular(run)}
    assert done["a"]["outcome"] == "loaded" and done["b"]["outcome"] == "empty"
    assert {r.load_type for r in run.control().collect()} == {"Full"}


def test_a_scheduled_load_without_dates_keeps_its_target(spark, sf):
    src = fx.src_orders(spark, sf)
    run = make_run(
        spark, sf, items("Full", schedule="Full", has_update_date="false"),
    )
    target = f"{run.target_root}/s0/orders_src"
    replace_load(src, target)
    (done,) = flows.run_scheduled(run)
    assert done["outcome"] == "extract_failed" and "no date window" in done["extract_error"]
    assert read_target(spark, target).count() == src.count()
    assert run.control().first().schedule == "Full"


def plain_steps(run):
    def steps(item, name):
        return flows.Steps(
            lambda: flows._count(run, item),
            lambda _: flows._stage(run, item, name, run.read(item.source_table)),
            lambda staged: flows._load(run, item, staged),
        )

    return steps


def due(run):
    return flows.work_list(run, flows.sel.route(run.control()).drop("route"))


def test_two_runs_beside_each_other_keep_both_results(spark, sf, monkeypatch):
    run = make_run(spark, sf, items("Full", "Full"))
    first, second = ([i] for i in due(run))
    real, calls = flows._record, []

    def between(run, result, scheduled):
        # the second run starts, ends and records while the first one is about to record
        if not calls:
            calls.append(1)
            flows._run_items(run, second, plain_steps(run))
        real(run, result, scheduled)

    monkeypatch.setattr(flows, "_record", between)
    flows._run_items(run, first, plain_steps(run))
    rows = uid_rows(run.control())
    assert rows["t0"].load_type == rows["t1"].load_type == "CDC"
    assert run.stats().filter("load_status = 'Success'").count() == 2


def test_an_older_result_recorded_late_does_not_win(spark, sf):
    """Two runs of one table: the one that ended first records last."""
    run = make_run(spark, sf, items("Full"))
    (item,) = due(run)
    blank = flows._blank(item, (10, None, None), None)
    late = {**blank, "finished_at": "1998-06-15 09:00:00", "rows_after": 10, "file_name": "late"}
    early = {**blank, "finished_at": "1998-06-15 08:00:00", "rows_after": 3, "file_name": "early"}
    for result in (late, early, late):
        flows._record(run, result, False)
    row = run.control().first()
    assert (row.target_row_count, row.load_type) == (10, "CDC")
    assert row.last_update_date == "1998-06-15 09:00:00"
    assert run.results().count() == 2


def test_a_change_of_control_during_a_run_stays(spark, sf):
    run = make_run(spark, sf, items("Full"))
    source = run.read

    def read(name):
        if not changed:
            changed.append(1)
            flows.edit_control(run, run.control().select("table_uid", F.lit(9).alias("priority")))
        return source(name)

    changed = []
    run.read = read
    flows.run_regular(run)
    row = run.control().first()
    assert (row.priority, row.load_type) == (9, "CDC")


def test_edits_after_a_result_stay_in_force(spark, sf):
    """A table is told to load whole again; no later start puts the result back over it."""
    run = make_run(spark, sf, items("Full"))
    flows.run_regular(run)
    assert run.control().first().load_type == "CDC"
    edit = run.control().select(
        "table_uid", F.lit("true").alias("schedule"), F.lit("Full").alias("load_type"),
        F.lit("1998-06-14 00:00:00").alias("last_update_date"),
    )
    flows.edit_control(run, edit, at="1998-06-15 07:00:00")
    assert flows.run_regular(run) == []  # scheduled now
    row = run.control().first()
    assert (row.schedule, row.load_type) == ("true", "Full")
    run.clock = lambda: datetime(1998, 6, 15, 8, 0, 0)
    (done,) = flows.run_scheduled(run)
    assert done["outcome"] == "loaded"
    assert run.control().first().schedule == "false"


def test_results_of_a_run_that_died_are_known_to_the_next(spark, sf, monkeypatch):
    run = make_run(spark, sf, items("Full", "Full"))
    real = flows._record

    def dies(run, result, scheduled):
        real(run, result, scheduled)
        raise KeyboardInterrupt

    monkeypatch.setattr(flows, "_record", dies)
    with pytest.raises(KeyboardInterrupt):
        flows._run_items(run, due(run), plain_steps(run))
    monkeypatch.setattr(flows, "_record", real)
    assert sorted(r.load_type for r in run.control().collect()) == ["CDC", "Full"]
    (done,) = flows.run_regular(run)  # the other one ran today
    assert done["table_uid"] == "t1"
    assert {r.load_type for r in run.control().collect()} == {"CDC"}


def test_what_a_flow_writes_does_not_grow_with_its_history(spark, sf):
    run = make_run(spark, sf, items("Full"))
    written = []
    for day in range(3):
        held = {p for p in Path(run.stats_path).rglob("*.parquet")}
        run.as_of, run.clock = datetime(1998, 6, 15 + day).date(), lambda d=day: datetime(1998, 6, 15 + d, 4)
        flows.run_regular(run)
        new = {p for p in Path(run.stats_path).rglob("*.parquet")} - held
        assert held <= {p for p in Path(run.stats_path).rglob("*.parquet")}
        written.append((len(new), sum(p.stat().st_size for p in new)))
    assert {n for n, _ in written} == {2}
    assert max(size for _, size in written) < 1.1 * min(size for _, size in written)
    before, told = sorted(map(tuple, run.stats().collect())), run.control().collect()
    for day in range(3):
        flows.tidy(run, datetime(1998, 6, 15 + day).date())
    assert sorted(map(tuple, run.stats().collect())) == before
    assert run.control().collect() == told


@pytest.mark.parametrize("flow", ["batched", "Batches", "true"])
def test_a_source_without_any_date_keeps_its_target(spark, sf, flow):
    src = fx.src_orders(spark, sf)
    undated = src.withColumn("last_update_date", F.lit(None).cast("timestamp_ntz"))
    settings = {"batched": "true"} if flow == "batched" else {"schedule": flow}
    run = make_run(spark, sf, items("Full", **settings), read={"orders_src": lambda: undated},
                   window_cost="row_count")
    target = f"{run.target_root}/s0/orders_src"
    replace_load(src, target)
    (done,) = (flows.run_batched if flow == "batched" else flows.run_scheduled)(run)
    assert done["outcome"] == "extract_failed" and "date window" in done["extract_error"]
    assert read_target(spark, target).count() == src.count()
    row = run.control().first()
    assert row.last_update_date == "1998-06-14 04:00:00" and row.load_type == "Full"


def test_rules_for_rows_without_a_window(spark, sf):
    src = fx.src_orders(spark, sf)
    holes = src.withColumn(
        "last_update_date", F.when(F.col("o_orderkey") % 5 > 0, F.col("last_update_date"))
    )
    for rule, kind, outcome in (
        ("report", {"batched": "true"}, "loaded"), ("load", {"batched": "true"}, "loaded"),
        ("fail", {"batched": "true"}, "extract_failed"), ("load", {"schedule": "true"}, "loaded"),
        ("fail", {"schedule": "true"}, "extract_failed"),
    ):
        run = make_run(spark, sf, items("Full", **kind), read={"orders_src": lambda: holes},
                       window_cost="row_count", remainder=rule)
        run.as_of = fx.DATA_END
        (done,) = (flows.run_batched if "batched" in kind else flows.run_scheduled)(run)
        assert done["outcome"] == outcome, (rule, kind)
        left = holes.where("last_update_date IS NULL").count()
        if outcome == "loaded":
            assert done["left_out"] == (left if rule == "report" else 0)
            assert done["processed"] == src.count() - done["left_out"]
            assert run.stats().first().left_out_rows == str(done["left_out"])
            assert run.control().first().load_type == ("Full" if rule == "report" else "CDC")


def test_a_target_without_a_name_is_a_failure_with_a_message(spark, sf):
    run = make_run(
        spark, sf,
        [{"table_uid": "v", "source_table": "orders_src", "load_type": "Validation",
          "return_fields": "o_orderkey"}],
    )
    (done,) = flows.run_regular(run)
    assert done["outcome"] == "extract_failed" and "target" in done["extract_error"]


def test_keys_that_spell_missing_stay_apart(spark, sf):
    rows = spark.createDataFrame(
        [("NA", "a"), ("None", "NA"), ("null", "c"), ("x", "null")], "k string, v string"
    ).selectExpr("*", "TIMESTAMP_NTZ'1998-06-14 01:00:00' AS last_update_date",
                 "TIMESTAMP_NTZ'1998-06-14 01:00:00' AS creation_date")
    run = make_run(
        spark, sf,
        [{"table_uid": "t", "source_table": "t", "load_type": "CDC", "primary_key": "k"}],
        read={"t": lambda: rows},
    )
    flows.run_regular(run)
    got = {r.k: r.v for r in read_target(spark, f"{run.target_root}/dw/t").collect()}
    assert got == {"NA": "a", "None": None, "null": "c", "x": None}
    run = make_run(
        spark, sf, [{"table_uid": "t", "source_table": "t", "load_type": "Full"}],
        read={"t": lambda: rows}, na_tokens=("c",), strip_null=True,
    )
    flows.run_regular(run)
    got = {(r.k, r.v) for r in read_target(spark, f"{run.target_root}/dw/t").collect()}
    assert got == {("NA", "a"), ("None", "NA"), (None, None), ("x", None)}


def test_failures_are_recorded_and_retried(spark, sf):
    def broken():
        raise OSError("source not reached")

    unfit = fx.src_orders(spark, sf).withColumn("o_totalprice", F.lit("much"))
    run = make_run(
        spark,
        sf,
        [
            {"table_uid": "gone", "source_table": "gone", "load_type": "Full"},
            {"table_uid": "unfit", "source_table": "unfit", "load_type": "Full"},
            {"table_uid": "empty", "source_table": "empty", "load_type": "Full"},
        ],
        read={
            "gone": broken,
            "unfit": lambda: unfit,
            "empty": lambda: fx.src_orders(spark, sf).filter("o_orderkey < 0"),
        },
    )
    # the target of "unfit" holds numbers already, and text does not fit
    replace_load(fx.src_orders(spark, sf), f"{run.target_root}/dw/unfit")
    done = {d["table_uid"]: d for d in flows.run_regular(run)}
    assert done["gone"]["outcome"] == "extract_failed" and done["unfit"]["load_error"]
    control = uid_rows(run.control())
    before = "1998-06-14 04:00:00"
    assert control["gone"].last_update_date == before == control["unfit"].last_update_date
    assert control["gone"].extract_error == "source not reached"
    assert control["unfit"].load_error and control["unfit"].load_type == "Full"
    assert control["empty"].zero_rows and control["empty"].last_update_date > before
    assert read_target(spark, f"{run.target_root}/dw/unfit").count() > 0
    assert {d["table_uid"] for d in flows.run_regular(run)} == {"gone", "unfit"}


def test_undated_rows_keep_a_windowed_load_from_promotion(spark, sf):
    src = fx.src_orders(spark, sf).filter(F.to_date("last_update_date") <= fx.AS_OF)
    holes = src.withColumn(
        "last_update_date", F.when(F.col("o_orderstatus") != "P", F.col("last_update_date"))
    )
    run = make_run(
        spark,
        sf,
        [
            {"table_uid": "holes", "source_table": "holes", "load_type": "Full", "batched": "true"},
            {"table_uid": "whole", "source_table": "whole", "load_type": "Full", "batched": "true"},
        ],
        read={"holes": lambda: holes, "whole": lambda: src},
        window_cost="row_count",
        window_limit=25,
    )
    done = {d["table_uid"]: d for d in flows.run_batched(run)}
    control = uid_rows(run.control())
    missing = holes.filter("last_update_date IS NULL").count()
    assert done["holes"]["source_count"] - done["holes"]["rows_after"] == missing > 0
    assert done["holes"]["left_out"] == missing and done["whole"]["left_out"] == 0
    assert control["holes"].load_type == "Full" and control["whole"].load_type == "CDC"


def test_manual_range_adds_without_truncation(spark, sf):
    manual = {
        "schedule": "Manual", "schedule_begin": "1998-02-10", "schedule_end": "1998-03-05",
        "schedule_truncate": "false",
    }
    run = make_run(spark, sf, items("Full", **manual))
    src = fx.src_orders(spark, sf)
    target = f"{run.target_root}/s0/orders_src"
    replace_load(src.filter(F.to_date("last_update_date") < "1998-02-10"), target)
    before = read_target(spark, target).count()
    (done,) = flows.run_scheduled(run)
    span = F.to_date("last_update_date").between("1998-02-10", "1998-03-05")
    assert done["rows_after"] == before + src.filter(span).count()
    row = run.control().first()
    assert row.schedule == "false" and row.inserted_rows is None


def test_freeform_appends_unless_told_to_truncate(spark, sf, tmp_path):
    fx.table(spark, sf, "nation").createOrReplaceTempView("nation")
    free = {"load_type": "FreeForm", "freeform_sql": "SELECT n_name FROM nation"}
    for truncate, wanted in (("true", 25), ("false", 50)):
        run = make_run(
            spark, sf,
            [{"table_uid": "n", "source_table": "n", "freeform_truncate": truncate, **free}],
        )
        flows.run_freeform(run)
        again = run.control().select("table_uid", F.lit("").alias("last_update_date"))
        flows.edit_control(run, again)
        run.clock = lambda: datetime(1998, 6, 15, 5, 0, 0)
        run.stats_export = str(tmp_path / truncate)
        (done,) = flows.run_freeform(run)
        exported = read_landing_csv(spark, f"{run.stats_export}/{done['file_name']}")
        assert exported.first().load_status == "Success"
        assert read_target(spark, f"{run.target_root}/dw/n").count() == wanted
        assert run.control().first().load_type == "FreeForm"
