"""Stopping a run-once stream some time after its end row has come by."""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ferryline.operators.filters import drop_control_rows, is_control_row
from ferryline.sinks.paths import Files
from ferryline.streaming.land import BatchWriter

# Seconds a run-once feed goes on after its end row.
GRACE_SECONDS = 30


class EndSignal:
    """Wraps a writer: takes end rows out of each batch and notes that one was there.

    The batch is kept while it is written, so looking for the end row does not fetch and
    decode it again. ``marker`` names a file that keeps the note for a restarted stream,
    whose end row came by before.
    """

    def __init__(self, write: BatchWriter, key: str, prefix: str, marker: str | None = None):
        self.seen = False
        self._marker = marker
        self._write = write
        self._key = key
        self._prefix = prefix

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._write(drop_control_rows(batch, self._key, self._prefix), batch_id)
            if not batch.where(is_control_row(self._key, self._prefix)).isEmpty():
                self.seen = True
                if self._marker is not None:
                    files = Files(batch.sparkSession, self._marker)
                    if not files.exists(self._marker):
                        files.write_text(self._marker, "end")
        finally:
            batch.unpersist()


    def came(self, spark: SparkSession) -> bool:
        """Whether the end row came by, in this run or an earlier one of the same stream."""
        if not self.seen and self._marker is not None:
            self.seen = Files(spark, self._marker).exists(self._marker)
        return self.seen


def run_until_end(
    query: StreamingQuery, signal: EndSignal, grace_seconds: float = GRACE_SECONDS
) -> None:
    """Wait for the end row, give late rows some time, then stop.

    It stops between micro-batches once one has found nothing new, and after as much time
    again if rows keep coming; what it leaves is there for the next run.
    """
    while not query.awaitTermination(1):
        if signal.came(_session()):
            if not query.awaitTermination(grace_seconds):
                last = time.monotonic() + max(grace_seconds, 5)
                while query.status["isTriggerActive"] or query.status["isDataAvailable"]:
                    if time.monotonic() > last or query.awaitTermination(0.2):
                        break
                query.stop()
            return


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
