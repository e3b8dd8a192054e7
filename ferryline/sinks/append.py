"""Appends and batch replacement on Parquet tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ferryline.sinks.loads import is_compacted
from ferryline.sinks.paths import Files


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """At-least-once append."""
    df.write.mode("append").partitionBy(*(partition_by or [])).parquet(path)


def create_if_absent(spark: SparkSession, path: str, schema: StructType) -> bool:
    """An empty table with a schema, unless there is one already."""
    if Files(spark, path).exists(path):
        return False
    empty_frame(spark, schema).write.mode("ignore").parquet(path)
    return True


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table as stored, or with a declared schema and without columns only the layout has.

    The declared schema also keeps partition values in their type: text such as ``0007``
    would otherwise be read as a number.
    """
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def replace_batch(
    df: DataFrame,
    path: str,
    batch: object,
    column: str = "batch_number",
    batch_type: str = "string",
) -> None:
    """Make ``df`` the whole content of one batch.

    Only the directory of the batch is written, other batches are not read. The new
    files replace the old ones when the job commits, so a load that fails before leaves the
    old batch in place, and loading a batch twice equals loading it once. The commit itself
    deletes and then renames: if the driver is lost in it, load the batch again.
    """
    files = Files(df.sparkSession, path)
    stored = files.partition(path, column, batch)
    before = files.file_names(stored)
    _overwrite_partitions(df.withColumn(column, F.lit(batch).cast(batch_type)), path, column)
    if before and files.file_names(stored) == before:
        # No row, so the job named no partition to replace: empty the batch here.
        files.delete(stored)


def replace_batches(
    df: DataFrame,
    path: str,
    column: str = "batch_number",
    batches: Iterable[object] = (),
    gather: bool = True,
) -> None:
    """Replace every batch that occurs in ``df``, in one job.

    Rows are gathered by batch so that a task writes few files; Spark splits a batch
    that is much larger than the others over several tasks. ``batches`` lists ids that
    must end up empty when ``df`` has no row for them. Without ``gather`` rows are written
    where they are, for frames whose tasks hold the rows of few batches each.
    """
    files = Files(df.sparkSession, path)
    before = set(files.directory_names(path))
    _overwrite_partitions(df.hint("rebalance", column) if gather else df, path, column)
    # Only batches that were there can have rows left.
    listed = [b for b in batches if files.partition(path, column, b).rpartition("/")[2] in before]
    if listed:
        found = {
            row[0] for row in df.where(F.col(column).isin(listed)).select(column).distinct().collect()
        }
        for batch in listed:
            if batch not in found:
                files.delete(files.partition(path, column, batch))


def append_once(df: DataFrame, path: str, load_id: object, column: str = "load_id") -> None:
    """Append that can be repeated: the load is a batch, and a replay replaces it.

    A load that has become part of a compacted one (``compact_loads``) is there already.
    """
    if is_compacted(Files(df.sparkSession, path), path, load_id):
        return
    kind = "bigint" if isinstance(load_id, int) else "string"
    replace_batch(df, path, load_id, column, kind)


def _overwrite_partitions(df: DataFrame, path: str, column: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
