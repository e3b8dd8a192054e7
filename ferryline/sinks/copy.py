"""Copies of whole tables whose schema is found at run time."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ferryline.operators.keyed import ORDER
from ferryline.sinks.append import append
from ferryline.sinks.evolve import aligned, follow
from ferryline.sinks.keyed import KeyedTable
from ferryline.sinks.layout import ordered_by
from ferryline.sinks.paths import Files
from ferryline.sources.changelog import DELETED
from ferryline.sources.tables import TableRef

Select = Callable[[DataFrame], DataFrame]


def copy_table(
    spark: SparkSession,
    source: TableRef,
    path: str,
    select: Select | None = None,
    buckets: int | None = None,
    order: str | None = None,
) -> DataFrame:
    """Copy the selected rows of a table into one with the same columns; gives the copy.

    The target is created if absent. With a key, which the source declares to be unique,
    rows of a repeated copy overwrite those with the same key; without one they are appended,
    by ranges of the column ``order`` if that is given.

    The target follows a source whose schema has changed since the last copy: columns may be
    added, dropped (they stay, and are null in new rows) and widened. Any other change fails by
    name before a row is written (``SchemaChanged``).
    """
    df = source.read(spark)
    rows = select(df) if select else df
    schema = follow(spark, path, rows.schema, source.keys, _undeclared(spark, path))
    if source.keys:
        target = KeyedTable(path, schema, source.keys, buckets)
        target.upsert(aligned(rows, schema), [])
        return target.read(spark)
    rows = aligned(rows, schema)
    append(ordered_by(rows, order) if order else rows, path)
    return spark.read.schema(schema).parquet(path)


def _undeclared(spark: SparkSession, path: str) -> StructType | None:
    """The schema of a table that was written before copies declared one."""
    files = Files(spark, path)
    listed = files.file_names(path) + files.directory_names(path)
    if not any(n.endswith(".parquet") or n.startswith("_of=") for n in listed):
        return None
    return spark.read.parquet(path).drop("_of", "_bucket", ORDER, DELETED).schema


def copy_tables(
    spark: SparkSession,
    sources: Mapping[str, TableRef],
    base: str,
    select: Mapping[str, Select] | None = None,
    buckets: int | None = None,
    order: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """One copy per listed table. The list is metadata-sized, each copy is one Spark job.

    ``order`` names the column that a table without a key is laid out by.
    """
    select, order = select or {}, order or {}
    return {
        name: copy_table(spark, source, f"{base}/{name}", select.get(name), buckets, order.get(name))
        for name, source in sources.items()
    }
