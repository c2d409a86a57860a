"""Date and instant expressions (F4-F14). The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_utc(ts: Column) -> Column:
    return F.to_date(ts)


def iso_week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", day))


def sunday_week_start(day: Column) -> Column:
    """Sunday of the week (F8); dayofweek counts Sunday as 1."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 with microseconds kept."""
    return F.unix_micros(ts) / F.lit(1_000_000)


def whole_hours_between(start: Column, end: Column) -> Column:
    """Complete hours from start to end."""
    return F.timestamp_diff("HOUR", start, end)
