from __future__ import annotations

import calendar
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidegate.operators import counts as C
from tidegate.operators import windows as W
from tidegate.operators.joins import assign_window

ONE_DAY = timedelta(days=1)
AS_OF = date(2024, 3, 15)


def months_between(first: date, last: date) -> list[tuple[date, date]]:
    found, year, month = [], first.year, first.month
    while not found or (year, month) <= (last.year, last.month):
        found.append((date(year, month, 1), date(year, month, calendar.monthrange(year, month)[1])))
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return found


@pytest.fixture(scope="module")
def starts():
    pick = random.Random(7)
    days = [date(2019, 1, 1) + timedelta(days=pick.randrange(2400)) for _ in range(60)]
    # leap day, month ends, after as_of, none at all
    days += [date(2024, 2, 29), date(2023, 12, 31), date(2024, 3, 31), date(2025, 7, 4), None]
    return list(enumerate(days))


@pytest.fixture(scope="module")
def months(spark, starts):
    df = spark.createDataFrame(starts, "id int, min_update_date date")
    return W.month_windows(df, AS_OF, ["id"]).cache()


def by_id(df):
    found = {}
    for r in df.orderBy("begin_date").collect():
        found.setdefault(r.id, []).append((r.begin_date, r.end_date))
    return found


def test_months_are_whole_and_complete(months, starts):
    got = by_id(months)
    for key, first in starts:
        assert got[key] == months_between(first or W.DEFAULT_START, AS_OF)


def test_weeks_cut_each_month_at_mondays(months):
    weeks, whole = by_id(W.week_windows(months, ["id"])), by_id(months)
    for key, spans in weeks.items():
        for begin, end in spans:
            assert begin.month == end.month and begin <= end <= begin + 6 * ONE_DAY
            assert begin.day == 1 or begin.weekday() == 0
            assert (end + ONE_DAY).day == 1 or end.weekday() == 6
        assert all(a[1] + ONE_DAY == b[0] for a, b in zip(spans, spans[1:]))
        assert spans[0][0] == whole[key][0][0] and spans[-1][1] == whole[key][-1][1]


def test_a_month_of_six_weeks(spark):
    df = spark.createDataFrame([(date(2023, 7, 5),)], "min_update_date date")
    weeks = W.week_windows(W.month_windows(df, date(2023, 7, 31)))
    assert weeks.count() == 6  # 1-2, 3-9, ..., 31


def test_days_do_not_leave_their_week(months):
    weeks = W.week_windows(months, ["id"])
    days = by_id(W.day_windows(weeks, ["id"]))
    for key, spans in by_id(months).items():
        wanted, day = [], spans[0][0]
        while day <= spans[-1][1]:
            wanted.append((day, day))
            day += ONE_DAY
        assert days[key] == wanted


def sized(spark, costs):
    rows = [(day, n) for day, n in costs.items()]
    return spark.createDataFrame(rows, "day date, row_count bigint")


@pytest.mark.parametrize("limit", [1, 7, 40, 150, 10_000])
def test_adaptive_windows_partition_the_months(spark, limit):
    pick = random.Random(limit)
    costs = {date(2024, 1, 1) + timedelta(days=i): pick.randrange(9) for i in range(75)}
    costs[date(2024, 2, 7)] = 300  # one hot day
    del costs[date(2024, 1, 20)]
    start = spark.createDataFrame([(date(2023, 11, 8),)], "min_update_date date")
    months = W.month_windows(start, AS_OF)
    got = W.adaptive_windows(sized(spark, costs), months, limit).orderBy("begin_date").collect()
    assert got[0].begin_date == date(2023, 11, 1) and got[-1].end_date == date(2024, 3, 31)
    assert all(a.end_date + ONE_DAY == b.begin_date for a, b in zip(got, got[1:]))
    assert sum(w.cost for w in got) == sum(costs.values())
    for w in got:
        days = [w.begin_date + i * ONE_DAY for i in range((w.end_date - w.begin_date).days + 1)]
        assert w.cost == sum(costs.get(d, 0) for d in days)
        assert w.oversize == (w.cost > limit)
        if w.oversize:
            assert w.grain == "day"
        if w.grain == "week":  # split only because the month did not fit
            month = sum(n for d, n in costs.items() if (d.year, d.month) == (days[0].year, days[0].month))
            assert month > limit
    assert got[0].grain == "month" and got[0].cost == 0


def test_assign_window_takes_each_dated_row_once(spark):
    rows = spark.range(3000).select(
        "id",
        F.when(
            F.col("id") % 7 != 0,
            F.expr("timestamp_ntz'2024-01-31 23:59:59' + make_dt_interval(cast(id % 50 as int))"),
        ).alias("last_update_date"),
    )
    months = W.month_windows(C.record_counts(rows), date(2024, 2, 10))
    for pieces in (months, W.week_windows(months), W.day_windows(months)):
        got = assign_window(rows, pieces)
        inside = rows.filter(F.to_date("last_update_date") <= date(2024, 2, 29))
        assert got.count() == inside.count() == got.select("id").distinct().count()
    span = (date(2024, 2, 1), date(2024, 2, 29))
    february = assign_window(rows, months, span=span)
    assert {r.window_id for r in february.select("window_id").distinct().collect()} == {"M20240201"}


def test_schedule_windows_by_mode(spark):
    day = date
    df = spark.createDataFrame(
        [
            ("a", "true", None, None, day(2024, 1, 5), day(2024, 2, 6)),
            ("b", "Full", None, None, None, None),
            ("c", "Batches", None, None, day(2024, 2, 6), day(2024, 2, 7)),
            ("d", "Manual", day(2023, 1, 1), day(2023, 1, 9), day(2024, 2, 6), None),
            ("e", "false", None, None, day(2024, 2, 6), None),
        ],
        "table_uid string, schedule string, schedule_begin date, schedule_end date,"
        " min_update_date date, max_update_date date",
    )
    got = sorted(
        (r.table_uid, r.window_id, r.begin_date, r.end_date)
        for r in W.schedule_windows(df, AS_OF).collect()
    )
    assert got == [
        ("a", "R20240105", day(2024, 1, 5), day(2024, 2, 6)),
        ("c", "M20240201", day(2024, 2, 1), day(2024, 2, 29)),
        ("c", "M20240301", day(2024, 3, 1), day(2024, 3, 31)),
        ("d", "R20230101", day(2023, 1, 1), day(2023, 1, 9)),
    ]


def test_one_pass_sizes_hold_the_counts(spark, sf):
    from checks.fixtures import src_events

    events = src_events(spark, sf).withColumn(
        "last_update_date", F.when(F.col("value") > 3, F.col("last_update_date"))
    )
    measured = C.measure_days(events, with_bytes=True)
    assert C.profile_counts(measured).first() == C.record_counts(events).first()
    undated = C.undated_rows(events).first()[0]
    assert undated and measured.filter("day IS NULL").first().row_count == undated
