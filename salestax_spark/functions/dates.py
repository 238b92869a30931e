"""Time handling. Everything is UTC and independent of the session time zone."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_today() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def as_date(value: dt.date | str | None) -> dt.date:
    if value is None:
        return utc_today()
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def months_before(day: dt.date, months: int) -> dt.date:
    """Same day of the month, clamped to the length of the target month."""
    count = day.year * 12 + day.month - 1 - months
    year, month = divmod(count, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return dt.date(year, month + 1, min(day.day, last))


def utc_midnight(day: dt.date) -> Column:
    """A literal, so that it reaches the Parquet scan as a pushed filter."""
    epoch = calendar.timegm(day.timetuple())
    return F.timestamp_seconds(F.lit(epoch))


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds.cast("long"))


def utc_now_iso() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat()
