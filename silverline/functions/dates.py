"""Date and time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The input formats.
DATE_FORMAT = "M/d/yyyy"
TIMESTAMP_FORMAT = "M/d/yyyy H:m:s"


def as_date(value: Column | dt.date | str) -> Column:
    """A date column from a column, a date or ISO text."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))


def parse_date(value: Column) -> Column:
    """`M/D/YYYY` text to a date, NULL when it is not one."""
    return F.try_to_date(value, DATE_FORMAT)


def parse_timestamp(value: Column) -> Column:
    """`M/D/YYYY h:m:s` text to a zone-less timestamp, NULL when it is not one."""
    return F.try_to_timestamp(value, F.lit(TIMESTAMP_FORMAT)).cast("timestamp_ntz")


def fiscal_year(day: Column, first_month: int = 7) -> Column:
    """The year a fiscal year starting in `first_month` ends in."""
    return F.year(day) + (F.month(day) >= first_month).cast("int")


def fiscal_quarter(day: Column, first_month: int = 7) -> Column:
    return (F.pmod(F.month(day) - first_month, F.lit(12)) / 3).cast("int") + 1


def day_index(day: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(day) - 1


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def in_business_hours(moment: Column, first_hour: int = 8, last_hour: int = 16) -> Column:
    """Monday to Friday, with the hour inside the inclusive bounds."""
    return day_index(moment).between(1, 5) & F.hour(moment).between(first_hour, last_hour)


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from start to end."""
    return F.date_diff(end.cast("date"), start.cast("date"))


def month_boundaries(start: Column, end: Column) -> Column:
    """Number of month starts crossed."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def year_boundaries(start: Column, end: Column) -> Column:
    """Number of year starts crossed."""
    return F.year(end) - F.year(start)


def shifted(day: Column | dt.date | str, days: int) -> Column:
    return F.date_add(as_date(day), days)


def us_text(day: Column) -> Column:
    """A date as `MM/DD/YYYY` text."""
    return F.date_format(day, "MM/dd/yyyy")


def window_kind(start: Column, end: Column) -> Column:
    """Name the shape of a date window: a whole month, one day, or something else."""
    whole_month = (F.dayofmonth(start) == 1) & (end == F.last_day(start))
    return F.when(whole_month, "full_month").when(start == end, "single_day").otherwise("custom")


def is_requestable(
    value: Column,
    asof: Column | dt.date | str,
    earliest: str | None = None,
    latest: str = "asof",
) -> Column:
    """Whether `M/D/YYYY` text is a real day within the allowed range.

    `latest` is `asof` (no future days) or `asof+1y` (up to a year ahead).
    """
    day = parse_date(value)
    bound = as_date(asof) if latest == "asof" else F.add_months(as_date(asof), 12)
    ok = day.isNotNull() & (day <= bound)
    if earliest:
        ok = ok & (day >= as_date(earliest))
    return F.coalesce(ok, F.lit(False))
