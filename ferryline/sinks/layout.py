"""The order of rows in files, so that cuts by time read few of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def ordered_by(df: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """Rows dealt to tasks by sampled ranges of a column and sorted by it in each task.

    Written so, each file, row group and page holds a narrow range of the column, and a
    predicate on it skips all others; Spark's Parquet scan does so for numbers, dates, text and
    timestamps with a zone, but not for zone-less timestamps. Spark samples the ranges, and merges small ones at run
    time unless ``partitions`` is given. A value that very many rows share is split over
    several tasks by a hash of the row, which does not change if a task is repeated; only rows
    that are equal in all columns stay together. Nulls come first.
    """
    order = [F.col(f"`{column}`"), _row_hash(df)]
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return dealt.sortWithinPartitions(f"`{column}`")


def _row_hash(df: DataFrame) -> Column:
    hashed = [F.col(f"`{f.name}`") for f in df.schema if not _unhashable(f.dataType)]
    return F.xxhash64(*hashed)


def _unhashable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_unhashable(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _unhashable(kind.elementType)
    return isinstance(kind, (MapType, VariantType))
