"""Time arithmetic on epoch milliseconds held in longs, always in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketflow.schema import DATE_FORMAT, DAY_MS, INSTANT_FORMAT

_FIXED_UNITS_MS = {
    "minute": 60_000,
    "hour": 3_600_000,
    "day": DAY_MS,
    "week": 7 * DAY_MS,
}
_MONTH_UNITS = {"month": 1, "quarter": 3, "year": 12}


def epoch_ms(ts: Column) -> Column:
    """Timestamp (with or without zone; the session is UTC) to epoch milliseconds."""
    return F.unix_millis(ts.cast("timestamp"))


def _epoch_day(ms: Column) -> Column:
    return F.floor(ms / F.lit(DAY_MS)).cast("int")


def format_date(ms: Column) -> Column:
    """The day as text."""
    return F.date_format(F.date_from_unix_date(_epoch_day(ms)), DATE_FORMAT)


def format_instant(ms: Column) -> Column:
    """Text such as `2024-01-02T09:45:00.000+0000`."""
    return F.date_format(F.timestamp_millis(ms), INSTANT_FORMAT)


def weekday(ms: Column) -> Column:
    """Day of the week, Monday 0 to Sunday 6."""
    # day 0 of the epoch was a Thursday
    return F.pmod(_epoch_day(ms) + F.lit(3), F.lit(7))


def next_business_day(ms: Column) -> Column:
    """The same time of day on the next Monday-to-Friday day; no holidays."""
    tomorrow = ms + F.lit(DAY_MS)
    day = weekday(tomorrow)
    skip = F.when(day > 4, F.lit(7) - day).otherwise(F.lit(0))
    return tomorrow + skip.cast("long") * F.lit(DAY_MS)


def lookback_start(end_ms: Column, interval: str) -> Column:
    """`end - interval` by the calendar, e.g. `5 YEARS` or `2 DAYS`."""
    return F.unix_millis(F.timestamp_millis(end_ms) - F.expr(f"INTERVAL {interval}"))


def bucket_start(ms: Column, multiplier: int, unit: str) -> Column:
    """Start of the bar of `multiplier` units that holds the instant.

    Minutes to weeks count from the epoch (weeks from the first Monday in it);
    months, quarters and years count in calendar months.
    """
    if multiplier < 1:
        raise ValueError("multiplier must be at least 1")
    if unit in _FIXED_UNITS_MS:
        width = F.lit(multiplier * _FIXED_UNITS_MS[unit]).cast("long")
        shift = F.lit(4 * DAY_MS if unit == "week" else 0).cast("long")
        return ms - F.pmod(ms - shift, width)
    if unit in _MONTH_UNITS:
        step = multiplier * _MONTH_UNITS[unit]
        day = F.date_from_unix_date(_epoch_day(ms))
        month = F.year(day) * 12 + F.month(day) - 1
        first = month - F.pmod(month, F.lit(step))
        start = F.make_date(
            F.floor(first / 12).cast("int"), F.pmod(first, F.lit(12)) + 1, F.lit(1)
        )
        return F.unix_date(start).cast("long") * F.lit(DAY_MS)
    raise ValueError(f"unknown unit {unit!r}")
