"""Calendar expressions: day numbers and day/week/month periods."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERIODS = ("day", "week", "month")


def parse_day(text: str) -> date:
    """A job argument in the form YYYYMMDD."""
    return datetime.strptime(text, "%Y%m%d").date()


def as_date(day: date | str | Column) -> Column:
    """A day given as a date, as YYYY-MM-DD or as a column."""
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def last_day_of(df: DataFrame, column: str = "event_date") -> Column:
    """The latest day in ``df`` as a scalar subquery, so that nothing runs on the driver."""
    return df.agg(F.max(column).alias("last_day")).scalar()


def period_start(day: Column, period: str) -> Column:
    """First day of the calendar period; weeks start on Monday."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, not {period!r}")
    return day if period == "day" else F.trunc(day, period)


def period_index(day: Column, period: str) -> Column:
    """The period as a running integer, so that neighbours differ by one."""
    if period == "day":
        return F.unix_date(day)
    if period == "week":
        # The week of 1970-01-01, a Thursday, is number 0 and starts three days earlier.
        return F.floor((F.unix_date(day) + 3) / 7).cast("int")
    if period == "month":
        return (F.year(day) - 1970) * 12 + F.month(day) - 1
    raise ValueError(f"period must be one of {PERIODS}, not {period!r}")


def period_from_index(index: Column, period: str) -> Column:
    """First day of the period numbered by :func:`period_index`."""
    if period == "month":
        return F.add_months(F.lit("1970-01-01").cast("date"), index)
    return F.date_from_unix_date(index * 7 - 3 if period == "week" else index)
