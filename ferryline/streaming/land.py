"""Landing a stream: each micro-batch goes through the same writers as a batch load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ferryline.streaming.run_mode import AT_ONCE, run_trigger

BatchWriter = Callable[[DataFrame, int], object]


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    files_per_batch: int = 1000,
    **options: str,
) -> DataFrame:
    """New files of a folder as a stream. Spark's checkpoint remembers the files it took."""
    return (
        spark.readStream.format(fmt)
        .schema(schema)
        .options(maxFilesPerTrigger=str(files_per_batch), **options)
        .load(path)
    )


def load_name(batch: DataFrame, batch_id: int) -> str:
    """A name for one micro-batch that no other stream and no file load can have.

    The id of the query is kept in its checkpoint: it is the same when a batch is
    repeated, and another one when a stream is started afresh.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if query is None:
        raise RuntimeError("not inside a micro-batch of a stream")
    return f"{query}-{batch_id}"


def land(
    stream: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    mode: str = AT_ONCE,
    interval: str = "60 seconds",
) -> StreamingQuery:
    """Start writing a stream. ``write(rows, batch_id)`` must bear being repeated.

    After a failure Spark delivers the last micro-batch again under the same id, so
    writers replace their load (``append_once``, named by ``load_name``) or merge by key.
    """
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**run_trigger(mode, interval))
        .start()
    )
