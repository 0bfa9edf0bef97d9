from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from tidegate.operators import joins as J
from tidegate.operators import windows as W
from tidegate.operators.slices import cdc_day_slice
from tidegate.plans import loads as L
from tidegate.plans.tables import PIECE, Target

KEY, NEWEST = ["id"], ["last_update_date"]


def frame(spark, data):
    """(id, value, created day, updated day) with days counted from 2024-01-01."""
    start = date(2024, 1, 1)
    return spark.createDataFrame(
        [(i, v, start + timedelta(days=c), start + timedelta(days=u)) for i, v, c, u in data],
        "id bigint, value string, creation_date date, last_update_date date",
    )


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "target")


def test_upsert_inserts_updates_and_keeps(spark, target, rows):
    L.replace_load(frame(spark, [(1, "a", 0, 0), (2, "b", 0, 0), (3, "c", 0, 0)]), target)
    staged = frame(spark, [(2, "B", 0, 5), (4, "d", 5, 5)])
    done = L.upsert_load(staged, target, KEY, NEWEST)
    assert (done.rows_before, done.rows_after, done.processed) == (3, 4, 2)
    assert rows(L.read_target(spark, target), "id", "value") == [
        (1, "a"),
        (2, "B"),
        (3, "c"),
        (4, "d"),
    ]
    again = L.upsert_load(staged, target, KEY, NEWEST)
    assert (again.rows_before, again.rows_after) == (4, 4)


def test_the_latest_of_several_versions_wins(spark, target, rows):
    staged = frame(
        spark, [(1, "old", 0, 1), (1, "new", 0, 9), (1, "mid", 0, 5), (2, "x", 0, 1), (2, "y", 0, 1)]
    )
    done = L.upsert_load(staged, target, KEY, NEWEST)
    assert done.processed == 2
    # equal dates: the greatest by all columns, whatever the order of arrival
    assert rows(L.read_target(spark, target), "id", "value") == [(1, "new"), (2, "y")]


def test_missing_keys_do_not_pile_up(spark, target):
    staged = frame(spark, [(None, "a", 0, 1), (1, "b", 0, 1)])
    for _ in range(3):
        L.upsert_load(staged, target, KEY, NEWEST)
    assert L.read_target(spark, target).count() == 2


def test_composite_keys(spark, target):
    assert J.parse_keys(" a, b ,c") == ["a", "b", "c"]
    rows = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "a int, b int, v string")
    L.replace_load(rows, target)
    L.upsert_load(spark.createDataFrame([(1, 2, "z")], rows.schema), target, ["a", "b"])
    assert {tuple(r) for r in L.read_target(spark, target).collect()} == {(1, 1, "x"), (1, 2, "z")}


def test_a_hot_key_is_merged_before_the_shuffle(spark):
    staged = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS id", "id AS v", "id % 100 AS rank"
    )
    latest = J.keep_latest(staged, ["id"], ["rank"])
    assert latest.count() == staged.select("id").distinct().count()
    assert latest.filter("id = 0").first().asDict() == {"id": 0, "v": 29_799, "rank": 99}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def files(target):
    """Data files of each piece."""
    found = {}
    for f in Path(target).glob(f"{PIECE}=*/*.parquet"):
        found.setdefault(f.parent.name.split("=")[1], set()).add(f.name)
    return found


def test_untouched_pieces_keep_their_files(spark, target):
    data = [(i, "v", i % 4 * 31, i % 4 * 31) for i in range(40)]
    L.replace_load(frame(spark, data), target, "date_format(creation_date, 'yyyyMM')")
    before = files(target)
    assert len(before) == 4
    L.upsert_load(frame(spark, [(1, "new", 31, 99), (100, "add", 62, 99)]), target, KEY, NEWEST)
    after = files(target)
    for month in ("202401", "202404"):
        assert before[month] == after[month]
    for month in ("202402", "202403"):  # holds the staged key, gets the new one
        assert not before[month] & after[month]
    assert Target(spark, target).sizes() == {"202401": 10, "202402": 10, "202403": 11, "202404": 10}


def test_untouched_pieces_are_not_opened(spark, target):
    """Where the cut follows the key, files of other pieces may be gone and no one sees it."""
    L.replace_load(frame(spark, [(i, "v", 0, 0) for i in range(50)]), target, "id % 10")
    for f in Path(target, f"{PIECE}=7").glob("*.parquet"):
        f.write_bytes(b"not a file of rows")
    table = Target(spark, target)
    touched = L._touched_pieces(
        table, table.layout(), {str(k) for k in range(10)}, frame(spark, [(3, "w", 0, 1)]), KEY
    )
    assert touched == {"3"}
    old = table.read(pieces=touched)
    assert old.count() == 5
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert f"{PIECE}#" in plan and "PartitionFilters: [" in plan


def test_a_piece_that_loses_all_rows_goes(spark, target):
    L.replace_load(frame(spark, [(1, "a", 0, 0), (2, "b", 40, 40)]), target, "month(creation_date)")
    L.upsert_load(frame(spark, [(1, "A", 70, 70)]), target, KEY, NEWEST)
    assert set(files(target)) == {"2", "3"}
    L.replace_load(frame(spark, [(9, "z", 0, 0)]), target)
    assert set(files(target)) == {"1"}


def test_layouts_grow_and_types_widen(spark, target, rows):
    L.append_load(spark.sql("SELECT 1 AS id, CAST(5 AS INT) AS v, DATE'2024-01-02' AS d"), target, "id % 2")
    L.append_load(
        spark.sql("SELECT 2 AS id, 7000000000 AS v, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS d, 'x' AS more"), target
    )
    L.append_load(spark.sql("SELECT 3 AS ID, CAST(6 AS SMALLINT) AS v"), target)  # narrower, fewer
    table = Target(spark, target)
    assert table.layout().struct.simpleString() == "struct<id:int,v:bigint,d:timestamp_ntz,more:string>"
    assert table.layout().number == 2 and table.layout().piece_by == "id % 2"
    assert rows(L.read_target(spark, target), "id", "v", "more") == [
        (1, 5, None), (2, 7_000_000_000, "x"), (3, 6, None),
    ]
    assert [str(r.d) for r in L.read_target(spark, target).where("id < 3").orderBy("id").collect()] == [
        "2024-01-02 00:00:00", "2024-01-02 03:04:05",
    ]
    # what takes in neither keeps the held type; values that do not fit are an error
    with pytest.raises(Exception, match="(?i)cast"):
        L.append_load(spark.sql("SELECT 4 AS id, 'much' AS v"), target)
    L.upsert_load(spark.sql("SELECT 1 AS id, 9L AS v, 'y' AS more, 1.5D AS new"), target, ["id"])
    assert rows(L.read_target(spark, target), "id", "v", "more", "new") == [
        (1, 9, "y", 1.5), (2, 7_000_000_000, "x", None), (3, 6, None, None),
    ]


@pytest.mark.parametrize(
    "old, new, want",
    [
        ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("float", "double", "double"),
        ("int", "double", "double"), ("decimal(5,2)", "decimal(10,4)", "decimal(10,4)"),
        ("date", "timestamp_ntz", "timestamp_ntz"), ("string", "int", "string"), ("double", "string", "double"),
    ],
)
def test_older_files_are_read_with_the_wider_type(spark, target, old, new, want):
    value = "DATE'2024-01-02'" if old == "date" else "'3'"
    L.append_load(spark.sql(f"SELECT CAST({value} AS {old}) AS v"), target)
    L.append_load(spark.sql(f"SELECT CAST({value} AS {new}) AS v"), target)
    got = L.read_target(spark, target)
    assert got.schema["v"].dataType.simpleString() == want
    assert got.distinct().count() == 1


def test_a_key_that_changes_its_piece_is_not_duplicated(spark, target, rows):
    L.replace_load(frame(spark, [(1, "a", 0, 0), (2, "b", 40, 40)]), target, "month(creation_date)")
    L.upsert_load(frame(spark, [(1, "A", 70, 70)]), target, KEY, NEWEST)
    assert rows(L.read_target(spark, target), "id", "value") == [(1, "A"), (2, "b")]


def test_hashed_pieces(spark, target):
    L.replace_load(frame(spark, [(i, "v", 0, 0) for i in range(50)]), target, "pmod(hash(id), 8)")
    L.upsert_load(frame(spark, [(i, "w", 0, 1) for i in range(40, 60)]), target, KEY, NEWEST)
    got = L.read_target(spark, target).groupBy("value").count().collect()
    assert {tuple(r) for r in got} == {("v", 40), ("w", 20)}


def test_pieces_of_the_key_are_found_without_the_target(spark, target, monkeypatch):
    L.replace_load(frame(spark, [(i, "v", 0, 0) for i in range(50)]), target, "id % 10")
    before = files(target)
    monkeypatch.setattr(L, "rows_with_match", None)  # the target's keys are not looked at
    L.upsert_load(frame(spark, [(3, "w", 0, 1), (104, "w", 0, 1)]), target, KEY, NEWEST)
    after = files(target)
    assert {p for p in before if before[p] != after[p]} == {"3", "4"}
    assert L.read_target(spark, target).count() == 51


def test_piece_names_stay_apart(spark, target):
    rows = spark.createDataFrame([("a/b",), ("a_b",), ("a:b",), (None,), ("",)], "p string")
    L.replace_load(rows, target, "p")
    assert len(files(target)) == 5
    assert L.read_target(spark, target).count() == 5


def test_empty_replace_keeps_and_empty_windows_clear(spark, target):
    full = frame(spark, [(1, "a", 0, 0)])
    none = full.filter("id < 0")
    L.replace_load(full, target)
    assert L.replace_load(none, target).rows_after == 1
    assert L.append_load(none, target).processed == 0
    windows = W.month_windows(
        spark.createDataFrame([(date(2030, 1, 1),)], "min_update_date date"), date(2030, 1, 9)
    )
    done = L.windowed_replace_load(full, windows, target)
    assert (done.rows_before, done.rows_after) == (1, 0)
    assert L.read_target(spark, target).count() == 0


def test_manual_windows_may_add_to_the_table(spark, target):
    full = frame(spark, [(1, "a", 0, 0), (2, "b", 40, 40)])
    L.replace_load(full, target)
    february = W.month_windows(
        spark.createDataFrame([(date(2024, 2, 1),)], "min_update_date date"), date(2024, 2, 9)
    )
    done = L.windowed_replace_load(full, february, target, truncate=False)
    assert (done.rows_before, done.rows_after, done.processed) == (2, 3, 1)


def test_full_then_daily_changes_equal_one_full(spark, sf, tmp_path, rows):
    """Rows only inserted or updated: loading day by day ends where one full load does."""
    src = fx.src_orders(spark, sf).cache()
    start, end = date(1998, 6, 1), date(1998, 6, 13)
    target = str(tmp_path / "daily")
    # the state at the start: older versions of what is updated later
    L.replace_load(fx.tgt_orders(spark, sf, str(start)), target, "year(creation_date)")
    day = start
    while day <= end:
        L.upsert_load(
            cdc_day_slice(src, day + timedelta(days=1)), target, ["o_orderkey"], NEWEST
        )
        day += timedelta(days=1)
    wanted = src.filter(F.to_date("creation_date") <= end).withColumn(
        "o_totalprice",
        F.when(F.to_date("last_update_date") > end, F.col("o_totalprice") - 1).otherwise(
            F.col("o_totalprice")
        ),
    )
    # a row created in the range and updated after it came with its final price
    created_late = F.to_date("creation_date") >= start
    wanted = wanted.drop("o_totalprice").join(src.select("o_orderkey", "o_totalprice"), "o_orderkey")
    got = L.read_target(spark, target)
    final = got.filter(created_late | F.to_date("last_update_date").between(start, end))
    same = wanted.filter(created_late | F.to_date("last_update_date").between(start, end))
    assert rows(final, *src.columns) == rows(same, *src.columns)
    assert got.count() == wanted.count() == got.select("o_orderkey").distinct().count()


def test_overwriting_one_release_keeps_the_others(spark, target, rows):
    one = spark.createDataFrame([("t", "c")], "table_name string, column_name string")
    two = spark.createDataFrame([("t", "c"), ("t", "d")], one.schema)
    L.release_snapshot(one, target, "23A")
    L.release_snapshot(one, target, "23B")
    L.release_snapshot(two, target, "23B")
    assert rows(L.read_target(spark, target), "release", "column_name") == [
        ("23A", "c"),
        ("23B", "c"),
        ("23B", "d"),
    ]


def test_a_failed_load_leaves_the_table(spark, target):
    L.replace_load(frame(spark, [(1, "a", 0, 0)]), target)
    broken = frame(spark, [(2, "b", 0, 0)]).withColumn("value", F.expr("raise_error('boom')"))
    with pytest.raises(Exception, match="boom"):
        L.append_load(broken.withColumn("value", F.col("value").cast("string")), target)
    assert L.read_target(spark, target).count() == 1
    for load in (L.replace_load, lambda df, t: L.upsert_load(df, t, KEY)):
        with pytest.raises(Exception, match="boom"):
            load(broken.withColumn("value", F.col("value").cast("string")), target)
        assert [r.value for r in L.read_target(spark, target).collect()] == ["a"]


def test_tags_and_match_sizes_agree_with_the_tally(spark, sf, target):
    src = fx.src_orders(spark, sf)
    L.replace_load(fx.tgt_orders(spark, sf, str(fx.SINCE)), target)
    before = fx.tgt_orders(spark, sf, str(fx.SINCE))  # the target's own files are replaced below
    staged = cdc_day_slice(src, fx.AS_OF, since=fx.SINCE)
    key = ["o_orderkey"]
    tags = {r[0]: r[1] for r in J.tag_staged(staged, before, key).groupBy("action").count().collect()}
    done = L.upsert_load(staged, target, key, NEWEST)
    inserts = done.rows_after - done.rows_before
    assert tags == {"insert": inserts, "update": done.processed - inserts}
    assert J.rows_without_match(staged, before, key).count() == tags["insert"]
    assert J.rows_with_match(staged, before, key).count() == tags["update"]
