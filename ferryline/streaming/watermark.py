"""Event time on streams, and what reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How far behind the newest row a row may be before state for it may be gone.
MAX_OUT_OF_ORDER = "3 seconds"


def with_event_time(df: DataFrame, column: str, delay: str = MAX_OUT_OF_ORDER) -> DataFrame:
    """Declare event time. A zone-less column is read as UTC, as Spark requires a zone here.

    No landing step keeps state, so late rows are still loaded; the watermark bounds
    the state of steps added after it, such as ``once``.
    """
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def once(
    stream: DataFrame, keys: list[str], column: str = "timestamp", within: str = "10 minutes"
) -> DataFrame:
    """Rows of a stream without those whose keys came before, within a time.

    ``keys`` are the place in a topic, for a topic that is read twice, or the record's own
    key and version, for a producer that sends again. Of rows with equal keys whose event
    times lie at most ``within`` apart, the first to arrive passes. Their keys are kept until
    the newest event time is that much further on, so the state holds the keys of that time,
    and rows that are older than it are dropped: a late row cannot be told from a repeated
    one any more. Null keys equal each other; rows without a time are dropped, as they have
    no place in time.
    """
    return with_event_time(stream, column, within).dropDuplicatesWithinWatermark(keys)
