from __future__ import annotations

from datetime import date

import pytest

from tidegate.operators import selection as sel
from tidegate.schemas import CONTROL
from tidegate.sources.control import STORE_FIELD_NAMES, parse_control, read_control

AS_OF = date(2024, 3, 9)

READY = {
    "Frequency": "Daily",
    "Active": "true",
    "Created": "true",
    "Schedule": "false",
    "Split": "false",
    "Prio": 1,
    "Sort": 1,
    "Instance": "prod",
    "Stamp": "2024-03-08 01:02:03",
}
NAMES = {
    "table_uid": "Key",
    "source_table": "Key",
    "load_type": "Type",
    "frequency": "Frequency",
    "active": "Active",
    "created": "Created",
    "schedule": "Schedule",
    "batched": "Split",
    "priority": "Prio",
    "sort_order": "Sort",
    "instance": "Instance",
    "last_update_date": "Stamp",
    "validation_table": "Check",
    "has_update_date": "Dated",
}
ITEMS = [
    {"Key": "cdc", "Type": "CDC"},
    {"Key": "full", "Type": "Full", "Sort": 3},
    {"Key": "split", "Type": "Full", "Split": "true"},
    {"Key": "split_cdc", "Type": "CDC", "Split": "true"},
    {"Key": "check", "Type": "Validation", "Check": "check_copy"},
    {"Key": "sfull", "Type": "Special_Full", "Sort": 2},
    {"Key": "scdc", "Type": "Special_CDC"},
    {"Key": "meta", "Type": "MetaData"},
    {"Key": "cols", "Type": "MetaData_Cols", "Frequency": "Monthly"},
    {"Key": "primarykeys", "Type": "MetaData_primarykeys"},
    {"Key": "free", "Type": "FreeForm", "Created": "false", "Schedule": None},
    {"Key": "off", "Type": "Full", "Active": "false"},
    {"Key": "absent", "Type": "Full", "Created": "false"},
    {"Key": "weekly", "Type": "Full", "Frequency": "Weekly"},
    {"Key": "shouting", "Type": "Full", "Active": "TRUE"},
    {"Key": "s_true", "Type": "Full", "Schedule": "true"},
    {"Key": "s_full", "Type": "Special_Full", "Schedule": "Full"},
    {"Key": "s_batches", "Type": "Full", "Schedule": "Batches"},
    {"Key": "s_manual", "Type": "Full", "Schedule": "Manual"},
    {"Key": "s_cdc", "Type": "CDC", "Schedule": "true"},
    {"Key": "today", "Type": "CDC", "Stamp": "2024-03-09 00:00:00", "Prio": 0},
    {"Key": "never", "Type": "CDC", "Stamp": None, "Prio": None, "Instance": "test"},
    {"Key": "blank", "Type": "CDC", "Stamp": "", "Prio": 0},
    {"Key": "no_dates", "Type": "CDC", "Dated": "false"},
]


@pytest.fixture(scope="module")
def control(spark, tmp_path_factory):
    import json

    path = tmp_path_factory.mktemp("control") / "items.json"
    path.write_text("\n".join(json.dumps({**READY, **item}) for item in ITEMS))
    return read_control(spark, str(path), field_names=NAMES).cache()


def keys(df):
    return {r.table_uid for r in df.collect()}


def test_fixed_schema_and_parsed_flags(control):
    assert control.schema.fieldNames() == CONTROL.fieldNames()
    assert [f.dataType for f in control.schema] == [f.dataType for f in CONTROL]
    got = {r.table_uid: r for r in control.collect()}
    assert got["cdc"].active is True and got["shouting"].active is False
    assert got["cdc"].has_update_date is True and got["no_dates"].has_update_date is False
    assert got["never"].priority is None and got["full"].sort_order == 3


REGULAR = {
    "cdc", "full", "split", "split_cdc", "check", "sfull", "scdc", "meta", "today", "never",
    "blank", "no_dates",
}


def test_selections(control):
    assert keys(sel.select_regular(control)) == REGULAR
    assert keys(sel.select_batched(control)) == {"split", "split_cdc"}
    assert keys(sel.select_scheduled(control)) == {"s_true", "s_full", "s_batches", "s_manual"}
    assert keys(sel.select_metadata(control)) == {"cols", "primarykeys"}
    assert keys(sel.select_freeform(control)) == {"free"}
    assert keys(sel.select_snapshot(control)) == REGULAR | {
        "primarykeys", "s_true", "s_full", "s_batches", "s_manual", "s_cdc",
    }


def test_run_arguments(control):
    assert keys(sel.apply_run_args(control, 0)) == {"today", "blank"}
    assert keys(sel.apply_run_args(control, "All", "test")) == {"never"}
    assert control.count() == sel.apply_run_args(control).count() == len(ITEMS)


def test_gate_lets_blank_stamps_run(control):
    gone = keys(control) - keys(sel.once_per_day_gate(control, AS_OF))
    assert gone == {"today"}


def test_route(control):
    routed = {r.table_uid: r.route for r in sel.route(control).collect()}
    assert [k for k, v in routed.items() if v == "batched"] == ["split"]


def test_targets_and_folders(control):
    named = sel.raw_prefix(sel.resolve_target(control, "All", "24A"), AS_OF, "zone")
    got = {r.table_uid: (r.target_table, r.raw_prefix) for r in named.collect()}
    assert got["check"] == ("check_copy", "zone/Validation/check/2024/03/09/")
    assert got["meta"] == ("meta_All_24A", "zone/MetaData/meta/2024/03/09/")
    assert got["scdc"] == ("scdc", "zone/CDC/scdc/2024/03/09/")
    assert got["free"] == ("free", "zone/FullTableLoads/free/2024/03/09/")
    assert got["sfull"] == ("sfull", "zone/FullTableLoads/sfull/2024/03/09/")


def test_order_is_total(control):
    work = sel.order_work(sel.select_regular(control)).collect()
    order = [r.table_uid for r in work]
    assert order[:2] == ["blank", "today"] and order[-1] == "never"
    assert order.index("sfull") < order.index("full")
    assert order[2:8] == sorted(order[2:8])


def test_missing_fields_are_null(spark):
    df = parse_control(spark.createDataFrame([("t",)], "table_uid string"))
    row = df.first()
    assert row.load_type is None and row.active is False and row.has_update_date is True


def test_a_store_without_a_required_field_is_an_error(spark, tmp_path):
    path = tmp_path / "control.json"
    path.write_text('{"TableName": "t", "TableName1": "s", "Type": "Full"}\n')
    with pytest.raises(ValueError, match="load_type"):
        read_control(spark, str(path), field_names=STORE_FIELD_NAMES)
