"""Event time and calendar expressions. Calendar days follow the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_COMPACT = "yyyyMMdd"
DAY_DASHED = "yyyy-MM-dd"


def event_time(ts: str | Column = "ts") -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(F.col(ts) if isinstance(ts, str) else ts)


def day_text(ts: str | Column = "ts", pattern: str = DAY_DASHED) -> Column:
    """Epoch milliseconds to a calendar day as text."""
    return F.date_format(event_time(ts), pattern)


def parse_time(text: str | Column) -> Column:
    """`yyyy-MM-dd[ HH:mm:ss[.SSS]]` to a timestamp; anything else is null."""
    return (F.col(text) if isinstance(text, str) else text).try_cast("timestamp")


def parse_day(text: str | Column) -> Column:
    """The calendar day a date-time text starts with, at midnight; the rest is ignored."""
    return F.substring(text, 1, 10).try_cast("date").cast("timestamp")
