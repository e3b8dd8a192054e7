"""Operators over keyed rows: latest row, upsert, delete-and-insert, change replay, ordered merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    IntegralType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from ferryline.sources.changelog import DELETED

# The place of a stored row's change in the order of all changes, as comparable bytes.
ORDER = "_order"

# Aggregation, ordering


def batch_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per batch. Spark counts within each task before it shuffles."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))


def first_row(df: DataFrame, *order: Column) -> DataFrame:
    """The first row in a stated order: a top-1, not a full sort."""
    return df.orderBy(*order).limit(1)


def latest_per_key(
    df: DataFrame, keys: list[str], sequence: list[str], tie_break: bool = True
) -> DataFrame:
    """Last write wins: one row per key, the one highest in ``sequence``.

    Rows that tie on the whole sequence are told apart by their other columns, so the
    result never depends on task order. Where the sequence is unique, as a place in a topic
    is, ``tie_break=False`` spares that, and allows columns that cannot be ordered. Spark turns rank = 1 into a limit inside each
    task before the shuffle, so a key with very many changes costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in sequence]
    order = [F.col(c).desc_nulls_last() for c in [*sequence, *(rest if tie_break else [])]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def partition_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Gather the rows of a key, for a following write or per-partition step.

    Spark merges small partitions and splits one that a hot key makes far too large.
    Joins and aggregations place rows themselves and do not need this.
    """
    return df.hint("rebalance", *keys)


# Keyed writes as pure frames. The changes are used twice, for their keys and for their
# rows, so expensive ones should be persisted or landed first.


def upsert(
    target: DataFrame, changes: DataFrame, keys: list[str], sequence: list[str]
) -> DataFrame:
    """The target after inserting new keys and overwriting known ones."""
    latest = latest_per_key(changes, keys, sequence).select(*target.columns)
    return _replace(target, latest, latest, keys)


def delete_insert(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The target without any row whose key occurs in ``rows``, plus ``rows``."""
    return _replace(target, rows, rows.select(*target.columns), keys)


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: list[str], sequence: list[str]
) -> DataFrame:
    """Replay a change log: only the last change of a key counts, deletes remove the key.

    Deleting an absent key does nothing.
    """
    latest = latest_per_key(changes, keys, sequence)
    kept = latest.where(~F.col(DELETED)).select(*target.columns)
    return _replace(target, latest, kept, keys)


def _replace(
    target: DataFrame, touched: DataFrame, rows: DataFrame, keys: list[str]
) -> DataFrame:
    untouched = target.join(touched.select(*keys).distinct(), keys, "left_anti").select(*target.columns)
    return untouched.unionByName(rows)


# Changes whose order holds across loads. Rows carry ORDER and DELETED; a deleted key stays as
# a row of its key, order and mark, so that an older change that comes later is told apart.


def order_key(schema: StructType, sequence: list[str]) -> Column:
    """Columns as bytes that compare like the columns do, first to last; null comes first.

    Whole numbers, times and dates take eight bytes and strings end with a zero byte, so keys
    of one table may come from sequences of different columns as long as the first column
    that differs is of one kind (a time, for files and messages).
    """
    return F.concat(*[_order_bytes(F.col(c), schema[c].dataType) for c in sequence])


def _order_bytes(column: Column, kind: object) -> Column:
    if isinstance(kind, StringType):
        made = F.concat(F.encode(column, "UTF-8"), F.unhex(F.lit("00")))
    else:
        if isinstance(kind, TimestampNTZType):
            column = column.cast("timestamp")
        if isinstance(kind, (TimestampNTZType, TimestampType)):
            number = F.unix_micros(column)
        elif isinstance(kind, DateType):
            number = F.unix_date(column).cast("bigint")
        elif isinstance(kind, IntegralType):
            number = column.cast("bigint")
        else:
            raise TypeError(f"changes cannot be ordered by {kind.simpleString()}")
        # With the sign bit turned, negative numbers come before others.
        made = F.unhex(F.lpad(F.hex(number.bitwiseXOR(F.lit(-(2**63)))), 16, "0"))
    return F.coalesce(F.concat(F.unhex(F.lit("01")), made), F.unhex(F.lit("00")))


def latest_changes(
    changes: DataFrame, keys: list[str], sequence: list[str], tie_break: bool = True
) -> DataFrame:
    """The last change of each key with ORDER and DELETED (false where there is no such column)."""
    latest = latest_per_key(changes, keys, sequence, tie_break)
    marks = {ORDER: order_key(changes.schema, sequence)}
    if DELETED not in changes.columns:
        marks[DELETED] = F.lit(False)
    return latest.withColumns(marks)


def merge_ordered(
    stored: DataFrame, changes: DataFrame, keys: list[str], gather: list[str] | None = None
) -> DataFrame:
    """One row per key: the one with the higher order, whichever of the two came later.

    Both frames have one row per key, ORDER and DELETED. Of equal orders the change counts,
    so a repeated load changes nothing. A change without an order always counts, and any
    change counts over a stored row without one. One shuffle by key, or by the columns
    ``gather``, which follow from the key and by which the result is then placed.
    """
    both = stored.withColumn("_new", F.lit(1)).unionByName(changes.withColumn("_new", F.lit(2)))
    unordered = F.when(F.col(ORDER).isNull() & (F.col("_new") == 2), 1).otherwise(0)
    order = [unordered.desc(), F.col(ORDER).desc_nulls_last(), F.col("_new").desc()]
    if gather:
        both = both.repartition(*gather)
    by = dict.fromkeys([*(gather or []), *keys])
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return both.withColumn("_rank", rank).where("_rank = 1").drop("_rank", "_new")


def merge_few(stored: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``merge_ordered`` for changes that are known to be small: stored rows are not shuffled.

    The changes are sent to every task, and used three times.
    """
    orders = changes.select(*keys, F.col(ORDER).alias("_change_order"))
    newer = stored.join(F.broadcast(orders), keys).where(F.col(ORDER) > F.col("_change_order"))
    counting = changes.join(F.broadcast(newer.select(*keys)), keys, "left_anti")
    kept = stored.join(F.broadcast(counting.select(*keys)), keys, "left_anti")
    return kept.select(*changes.columns).unionByName(counting)
