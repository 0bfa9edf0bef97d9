"""Date windows as data: month, week and day pieces, inclusive at both ends.

Inputs are one row per table (the counts) or the calendar they span, never the table's rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.functions.dates import month_start, trunc_day, week_start

ACCURACY = 10_000  # of quantiles of a day's update times
DEFAULT_START = date(2022, 9, 1)  # fixed value: first month when a table has no earliest update


def _window(df: DataFrame, by: Sequence[str], grain: str, begin: Column, end: Column) -> DataFrame:
    return df.select(
        *by,
        F.concat(F.lit(grain[0].upper()), F.date_format(begin, "yyyyMMdd")).alias("window_id"),
        F.lit(grain).alias("grain"),
        begin.alias("begin_date"),
        end.alias("end_date"),
    )


def month_windows(
    counts: DataFrame,
    as_of: date,
    by: Sequence[str] = (),
    default_start: date = DEFAULT_START,
) -> DataFrame:
    """Whole months from the month of ``min_update_date`` to the month of ``as_of``.

    A minimum after ``as_of`` gives its own month only.
    """
    first = month_start(F.coalesce(F.to_date("min_update_date"), F.lit(default_start)))
    last = F.greatest(first, month_start(F.lit(as_of)))
    months = counts.select(
        *by, F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("_m")
    )
    return _window(months, by, "month", F.col("_m"), F.last_day("_m"))


def week_windows(months: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Monday-to-Sunday weeks clipped to their month."""
    weeks = months.select(
        *by,
        "begin_date",
        "end_date",
        F.explode(
            F.sequence(week_start("begin_date"), F.col("end_date"), F.expr("interval 7 days"))
        ).alias("_w"),
    )
    begin = F.greatest("begin_date", "_w")
    end = F.least(F.col("end_date"), F.date_add("_w", 6))
    return _window(weeks, by, "week", begin, end)


def day_windows(windows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The single days of each window."""
    days = windows.select(*by, F.explode(F.sequence("begin_date", "end_date")).alias("_d"))
    return _window(days, by, "day", F.col("_d"), F.col("_d"))


def schedule_windows(scheduled: DataFrame, as_of: date, key: str = "table_uid") -> DataFrame:
    """Windows of scheduled loads by mode; input rows carry schedule, counts and manual dates.

    ``Batches`` takes whole months, ``true`` and ``Full`` one window over the table's update
    dates, ``Manual`` the given dates. A mode without dates gives no window.
    """
    mode = F.col("schedule")
    batches = month_windows(scheduled.filter(mode == "Batches"), as_of, [key])
    single = scheduled.filter(mode.isin("true", "Full", "Manual")).select(
        key,
        F.when(mode == "Manual", F.col("schedule_begin"))
        .otherwise(F.to_date("min_update_date"))
        .alias("_b"),
        F.when(mode == "Manual", F.col("schedule_end"))
        .otherwise(F.to_date("max_update_date"))
        .alias("_e"),
    )
    single = single.filter(F.col("_b") <= F.col("_e"))
    return batches.unionByName(_window(single, [key], "range", F.col("_b"), F.col("_e")))


def adaptive_windows(
    profile: DataFrame,
    months: DataFrame,
    limit: int,
    cost: str = "row_count",
    by: Sequence[str] = (),
) -> DataFrame:
    """One non-overlapping window set: a month, or its weeks, or their days, to stay in ``limit``.

    ``profile`` holds the cost per day. Months without rows stay one window. A single day beyond
    the limit cannot be split; it is marked ``oversize`` and still loaded.
    """
    by = list(by)
    days = months.select(
        *by,
        F.col("begin_date").alias("_month"),
        F.explode(F.sequence("begin_date", "end_date")).alias("day"),
    ).withColumn("_week", F.greatest(F.col("_month"), week_start("day")))
    sized = days.join(profile.select(*by, "day", cost), [*by, "day"], "left").withColumn(
        "_cost", F.coalesce(F.col(cost), F.lit(0)).cast("bigint")
    )
    per_month = W.partitionBy(*by, "_month")
    per_week = W.partitionBy(*by, "_month", "_week")
    month_fits = F.sum("_cost").over(per_month) <= limit
    week_fits = F.sum("_cost").over(per_week) <= limit
    chosen = sized.select(
        *by,
        "day",
        "_cost",
        F.when(month_fits, "month").when(week_fits, "week").otherwise("day").alias("grain"),
        F.when(month_fits, F.col("_month"))
        .when(week_fits, F.col("_week"))
        .otherwise(F.col("day"))
        .alias("begin_date"),
    )
    pieces = chosen.groupBy(*by, "grain", "begin_date").agg(
        F.max("day").alias("end_date"), F.sum("_cost").alias("cost")
    )
    return pieces.select(
        *by,
        F.concat(
            F.upper(F.substring("grain", 1, 1)), F.date_format("begin_date", "yyyyMMdd")
        ).alias("window_id"),
        "grain",
        "begin_date",
        "end_date",
        "cost",
        (F.col("cost") > limit).alias("oversize"),
    )


def split_days(
    df: DataFrame, windows: DataFrame, limit: int, updated: str = "last_update_date"
) -> DataFrame:
    """The windows, with single days beyond the limit cut into time ranges of about equal rows.

    Ranges begin at quantiles of the day's update times, twice as many as the limit asks for since
    quantiles are approximate. One pass over the oversize days gathers them, in summaries that merge.
    A range ends where the next one of its day begins; ``begin_at`` is NULL where a window begins
    with its day. Rows of one moment cannot be parted: their range may stay beyond the limit. Costs of
    ranges are the day's, divided.
    """
    large = windows.where(F.col("oversize") & (F.col("begin_date") == F.col("end_date"))).select(
        F.col("window_id").alias("_id"), F.col("begin_date").alias("_day"),
        (F.ceil(F.col("cost") / limit) * 2).alias("_n"),
    )
    most = large.agg(F.max("_n")).first()[0]  # one row per oversize day is looked at
    none = F.lit(None).cast("timestamp_ntz")
    if most is None:
        return windows.withColumn("begin_at", none)
    marks = F.array(*[F.lit(k / most) for k in range(1, most)])
    times = df.select(trunc_day(updated).alias("_day"), F.col(updated).cast("timestamp_ntz").alias("_at"))
    ranked = (
        times.join(large, "_day")
        .groupBy("_id", "_n")
        .agg(
            F.percentile_approx("_at", marks, ACCURACY).alias("_marks"), F.min("_at").alias("_first")
        )
    )
    # every most/n-th quantile; those at the day's first time would leave its first range empty
    chosen = F.filter(
        F.array_distinct(
            F.transform(
                F.sequence(F.lit(1), F.col("_n") - 1),
                lambda k: F.get("_marks", (F.floor(k * most / F.col("_n")) - 1).cast("int")),
            )
        ),
        lambda m: m > F.col("_first"),
    )
    begins = ranked.select(
        "_id", F.size(chosen).alias("_more"),
        F.posexplode(F.concat(F.array(none), chosen)).alias("_k", "begin_at"),
    )
    cut = windows.join(begins, F.col("window_id") == F.col("_id"), "left")
    cost = F.ceil(F.col("cost") / (F.coalesce("_more", F.lit(0)) + 1)).cast("bigint")
    part = F.concat_ws("-", "window_id", F.lpad(F.col("_k").cast("string"), 4, "0"))
    changed = {
        "window_id": F.when(F.col("_more") > 0, part).otherwise(F.col("window_id")),
        "grain": F.when(F.col("_more") > 0, "time").otherwise(F.col("grain")),
        "cost": cost,
        "oversize": cost > limit,
    }
    return cut.select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in windows.columns], "begin_at"
    )
