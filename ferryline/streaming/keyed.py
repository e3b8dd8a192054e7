"""A keyed step with a timer: a key closes some time after its end row."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructType

# What the added column says of a row: it came while its key was open, or after the key had
# closed; or it is the row that closes the key, with nulls beside the key.
STATE = "state"
OPEN, LATE, CLOSED = "open", "late", "closed"

_IS_END, _SHARE = "_is_end", "_share"
# Spark's Python worker holds what a group gives in a micro-batch until its last row, so the
# rows of a key are dealt to this many groups, each with the key's state.
SHARES = 256
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """State on the executors' disks instead of their heaps; keyed steps with timers need it.

    A stream that has run before goes on with the kind of state it began with.
    """
    if spark.conf.get(_PROVIDER, None) != _ROCKSDB:
        spark.conf.set(_PROVIDER, _ROCKSDB)


def close_after_end(
    stream: DataFrame, key: str, is_end: Column, grace_seconds: float = 30.0
) -> DataFrame:
    """Rows of a stream with the state of their key, without end rows.

    A key's first end row starts its timer. When that has run for the grace time, the key is
    closed: a row says so, and rows of the key that come later are marked. Keys do not wait
    for each other, and a restart keeps both timers and closed keys; a timer that ran out
    meanwhile fires at once. Rows without a key are one key. A micro-batch runs at each
    interval of the trigger even without new rows, so that timers fire; ``AT_ONCE`` fires
    those due.

    The rows of a key are dealt to SHARES groups, so that tasks share a hot key and a worker
    holds a small part of its rows at once. All of them see the key's end rows, in the same
    micro-batch and so at the same time; for each, one number and one flag are kept.
    """
    keep_state_on_disk(stream.sparkSession)
    schema = StructType([*stream.schema]).add(STATE, StringType())
    every = F.sequence(F.lit(0), F.lit(SHARES - 1))
    one = F.array(F.floor(F.rand(0) * SHARES).cast("int"))
    dealt = stream.withColumn(_IS_END, is_end).withColumn(
        _SHARE, F.explode(F.when(F.col(_IS_END), every).otherwise(one))
    )
    return dealt.groupBy(key, _SHARE).transformWithState(
        statefulProcessor=_Closing(key, stream.columns, int(1000 * grace_seconds)),
        outputStructType=schema,
        outputMode="Append",
        timeMode="ProcessingTime",
    )


class _Closing(StatefulProcessor):
    def __init__(self, key: str, columns: list[str], grace_ms: int):
        self._key, self._columns, self._grace = key, columns, grace_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("closing", "at BIGINT, closed BOOLEAN")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found = self._state.get() if self._state.exists() else None
        mark = LATE if found and found[1] else OPEN
        for row in rows:
            if not row[_IS_END]:
                yield Row(**{c: row[c] for c in self._columns}, **{STATE: mark})
            elif found is None:
                found = (timerValues.getCurrentProcessingTimeInMs() + self._grace, False)
                self._state.update(found)
                self._handle.registerTimer(found[0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._state.update((expiredTimerInfo.getExpiryTimeInMs(), True))
        if key[1] == 0:  # one row closes the key, whichever its shares
            values = dict.fromkeys(self._columns) | {self._key: key[0], STATE: CLOSED}
            yield Row(**values)

    def close(self) -> None:
        pass
