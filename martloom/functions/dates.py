"""Calendar arithmetic with boundary-counting differences and Sunday-first weekdays."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def date_key(d: Column) -> Column:
    """Integer yyyymmdd, by arithmetic so that it stays in generated code."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def as_date_key(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def years_crossed(start: Column, end: Column) -> Column:
    """Year boundaries between two dates, not whole years."""
    return F.year(end) - F.year(start)


def months_crossed(start: Column, end: Column) -> Column:
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries between two timestamps."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end))


def weekday_from_sunday(d: Column) -> Column:
    return F.dayofweek(d) - 1


def week_start(d: Column) -> Column:
    return F.trunc(d, "week")


def month_before(d: dt.date) -> dt.date:
    """First day of the month before the one that holds ``d``."""
    return (d.replace(day=1) - dt.timedelta(days=1)).replace(day=1)


def month_after(d: dt.date) -> dt.date:
    return (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def completed_years(born: Column, on: Column) -> Column:
    """Age: year boundaries, less one while the birthday is still to come."""
    ahead = (F.month(on) * 100 + F.dayofmonth(on)) < (F.month(born) * 100 + F.dayofmonth(born))
    return years_crossed(born, on) - ahead.cast("int")
