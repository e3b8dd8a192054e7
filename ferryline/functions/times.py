"""Dates, times of day and epochs.

The session zone is UTC (see ``session.SETTINGS``), so a zone-less timestamp cast
to TIMESTAMP keeps its wall clock. Other zones are always arguments.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since the epoch of a timestamp read as UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def local_to_epoch_ms(ts: Column, zone: str) -> Column:
    """Wall clock in ``zone`` to epoch milliseconds."""
    return F.unix_millis(F.to_utc_timestamp(ts.cast("timestamp"), zone))


def epoch_ms_to_local(ms: Column, zone: str) -> Column:
    """Epoch milliseconds to the wall clock in ``zone``."""
    return F.from_utc_timestamp(F.timestamp_millis(ms), zone).cast("timestamp_ntz")


def date_time_to_epoch_seconds(date: Column, time: Column) -> Column:
    """A date and a time-of-day text, read as UTC, to epoch *seconds*."""
    text = F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" "), time)
    return F.unix_seconds(F.to_timestamp(text))


def leading_date(text: Column, separator: str = "_", pattern: str = "yyyyMMdd") -> Column:
    """The date written before the first separator, as in ``20250303_x_01``."""
    return F.to_date(F.substring_index(text, separator, 1), pattern)


def time_of_day(text: Column) -> Column:
    """``HH:mm:ss[.SSS]`` text to TIME(3). Text that is no time of day is an error."""
    return text.cast("time(3)")


def time_of_day_text(time: Column) -> Column:
    """TIME to fixed-width ``HH:mm:ss.SSS`` text, which sorts like the time."""
    text = time.cast("time(3)").cast("string")
    return F.concat(
        F.substring(text, 1, 8), F.lit("."), F.rpad(F.substring(text, 10, 3), 3, "0")
    )


def time_of_day_seconds(time: Column) -> Column:
    """TIME cut to whole seconds, as ``HH:mm:ss`` text."""
    return F.substring(time.cast("time(3)").cast("string"), 1, 8)


def as_date(value: Column, pattern: str | None = None) -> Column:
    return F.to_date(value, pattern) if pattern else F.to_date(value)


def as_timestamp(value: Column, pattern: str | None = None) -> Column:
    return F.to_timestamp_ntz(value, F.lit(pattern)) if pattern else value.cast("timestamp_ntz")
