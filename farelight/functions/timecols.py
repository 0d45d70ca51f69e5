"""Time columns: week start, week key, hour and durations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_time(name: str) -> Column:
    """Tolerant cast; on a timestamp column it disappears from the plan."""
    return F.col(name).try_cast("timestamp")


def week_date(ts: Column) -> Column:
    """Monday of the week as a date."""
    return F.date_trunc("week", ts).cast("date")


# Hours, days and weeks begin at a multiple of this in every zone whose offset is whole
# quarter-hours.
SLOT_SECONDS = 900


def time_slot(ts: Column) -> Column:
    """Number of the quarter-hour since the epoch.

    Plain arithmetic, where hour and week need calendar work on every row: group by the
    slot first and take hour and week of :func:`slot_start` from the few groups.
    """
    return F.floor(F.unix_seconds(ts) / SLOT_SECONDS)


def slot_start(slot: Column) -> Column:
    return F.timestamp_seconds(slot * SLOT_SECONDS)


def year_week(ts: Column) -> Column:
    """``YYYY-WW`` from calendar year and ISO week; empty for a missing time."""
    week = F.lpad(F.weekofyear(ts).cast("string"), 2, "0")
    return F.concat_ws("-", F.year(ts).cast("string"), week)


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from whole-second times."""
    return (F.unix_seconds(end) - F.unix_seconds(start)) / F.lit(60.0)


def is_night(hour: Column) -> Column:
    """Midnight up to, not including, six in the morning."""
    return hour.between(0, 5)


def hour_range(hour: Column, width: int = 2) -> Column:
    """``HH-HH`` label that wraps at midnight."""
    return F.format_string("%02d-%02d", hour, (hour + width) % 24)
