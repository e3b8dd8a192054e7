"""Scalar functions, Column in and Column out. All null in, null out."""

from ferryline.functions.text import camel_case, chinese_numeral, has_prefix, snake_case
from ferryline.functions.times import (
    as_date,
    as_timestamp,
    date_time_to_epoch_seconds,
    epoch_ms,
    epoch_ms_to_local,
    leading_date,
    local_to_epoch_ms,
    time_of_day,
    time_of_day_seconds,
    time_of_day_text,
)

__all__ = [
    "as_date",
    "as_timestamp",
    "camel_case",
    "chinese_numeral",
    "date_time_to_epoch_seconds",
    "epoch_ms",
    "epoch_ms_to_local",
    "has_prefix",
    "leading_date",
    "local_to_epoch_ms",
    "snake_case",
    "time_of_day",
    "time_of_day_seconds",
    "time_of_day_text",
]
