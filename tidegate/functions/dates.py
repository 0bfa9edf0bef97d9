"""Date expressions used in predicates and windows.

They stay on dates and zone-less timestamps, so nothing depends on the session time zone.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = "yyyy-MM-dd"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc_day(ts: Column | str) -> Column:
    """The calendar day. A comparison of it with literals is pushed to the scan as a range."""
    return F.to_date(_col(ts))


def parse_day(text: Column | str, fmt: str = DAY) -> Column:
    return F.to_date(_col(text), fmt)


def days_before(as_of: date | Column, n: int) -> Column:
    return F.date_sub(as_of if isinstance(as_of, Column) else F.lit(as_of), n)


def upper(text: Column | str) -> Column:
    return F.upper(_col(text))


def trunc_hour(ts: Column | str) -> Column:
    ts = _col(ts)
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def week_start(day: Column | str) -> Column:
    """Monday of the day's week."""
    day = _col(day)
    return F.date_sub(day, F.weekday(day))


def month_start(day: Column | str) -> Column:
    return F.trunc(_col(day), "MM")


def stamp_day(stamp: Column | str) -> Column:
    """``YYYY-MM-DD`` part of a text time stamp; missing for blank or unreadable text."""
    return F.try_to_date(F.substring(_col(stamp), 1, 10), DAY)


def stamp_month(stamp: Column | str) -> Column:
    """First day of a text time stamp's month."""
    return month_start(stamp_day(stamp))
