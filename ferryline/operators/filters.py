"""Row filters. All are plain predicates, so Parquet and JDBC scans push them down."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

log = logging.getLogger(__name__)


def time_range(
    df: DataFrame, column: str, start_ms: int, end_ms: int, zone: str = "UTC"
) -> DataFrame:
    """Rows whose time lies between two epoch milliseconds, both included.

    The column holds epoch milliseconds or a timestamp; ``zone`` is that of zone-less ones.
    For a timestamp the bounds are converted, never the column, so that the scan can skip
    files and row groups; the last millisecond counts in full.
    """
    kind = df.schema[column].dataType
    time = F.col(column)
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        first, after = (F.timestamp_millis(F.lit(ms)) for ms in (start_ms, end_ms + 1))
        if isinstance(kind, TimestampNTZType):
            first, after = (
                F.convert_timezone(F.lit("UTC"), F.lit(zone), b.cast(kind)) for b in (first, after)
            )
        return df.where((time >= first) & (time < after))
    return df.where(time.between(F.lit(start_ms), F.lit(end_ms)))


def optional_time_range(
    df: DataFrame, column: str | None, start_ms: int, end_ms: int, zone: str = "UTC"
) -> DataFrame:
    """``time_range`` when the table has a time column, else every row."""
    if column is None:
        log.warning("table has no time column, all rows are taken")
        return df
    return time_range(df, column, start_ms, end_ms, zone)


def resolve_column(
    properties: DataFrame,
    label: str,
    name: str = "name",
    code: str = "code",
    position: str = "position",
) -> str | None:
    """The code of the first property with a label, or None. One row reaches the driver."""
    first = (
        properties.where(F.col(name) == label)
        .agg(F.min_by(code, position).alias("code"))
        .first()
    )
    return first["code"]


def key_equals(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def drop_nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def is_control_row(key: str, prefix: str) -> Column:
    """True for the end row a run-once producer sends last; false for a null key."""
    return F.coalesce(F.col(key).startswith(prefix), F.lit(False))


def drop_control_rows(df: DataFrame, key: str, prefix: str, run_once: bool = True) -> DataFrame:
    """Run-once feeds drop their end row; scheduled feeds pass every row."""
    return df.where(~is_control_row(key, prefix)) if run_once else df
