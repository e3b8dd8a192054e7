"""Keyed tables on plain Parquet: upsert, delete-and-insert, change replay.

Rows are spread over a fixed number of directories by a hash of the key, so a write reads
and rewrites only the directories its keys fall into; Spark's dynamic partition overwrite
puts them in place. Each row is stored with the order of the change it comes from, and a
deleted key as a row that says so.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ferryline.operators.keyed import (
    ORDER,
    latest_changes,
    latest_per_key,
    merge_few,
    merge_ordered,
)
from ferryline.sinks.append import empty_frame
from ferryline.sinks.paths import Files
from ferryline.sources.changelog import DELETED

DEFAULT_BUCKETS = 16
BUCKET_BYTES = 512 << 20
# Where Spark cannot tell a size, it assumes a very large one.
_UNKNOWN = 1 << 54
# A merge writes whole directories twice, so they are kept small.
_CODEC = ("compression", "zstd")

# Directories: how many there are, and which one a key falls into.
_OF, _BUCKET = "_of", "_bucket"
# Parts of a directory that tasks merge and write, by a hash of the key.
_SLICE = "_slice"
SLICE_BYTES = 32 << 20


@dataclass(frozen=True)
class KeyedTable:
    """A table with a key, for one writer at a time.

    A merge is first written in full beside the table and then put in place. If the driver is
    lost in between, the next write (or ``finish``) puts it in place again before it does
    anything else, so no stored row is lost. Readers should not overlap the second step; where
    they must, or where several writers meet, a ``MergeTable`` leaves that to a table format.

    ``buckets`` is for a new table; an existing one knows its own. It should put 128 MB
    to 1 GB into one directory at the expected size. None takes it from the size Spark
    knows for the first load, which suits copies that will not grow much.
    """

    path: str
    schema: StructType
    keys: tuple[str, ...]
    buckets: int | None = DEFAULT_BUCKETS

    def read(self, spark: SparkSession) -> DataFrame:
        return self.stored(spark).where(~F.col(DELETED)).select(*self.schema.names)

    def stored(self, spark: SparkSession) -> DataFrame:
        """All rows as stored: the columns, the order, and deleted keys with their mark."""
        return self._read(spark, self.path).drop(_OF, _BUCKET)

    def upsert(
        self,
        changes: DataFrame,
        sequence: list[str],
        tie_break: bool = True,
        across_loads: bool = False,
    ) -> None:
        """Insert new keys, overwrite known ones; the last change of a key wins.

        Without a sequence the keys of ``changes`` are unique already, and nothing is reduced.
        With ``across_loads`` the sequence also holds against what is stored: a change that is
        older than the one its key was last changed or deleted by does nothing. Otherwise it
        orders the changes of this load only, and the load counts over what is stored.
        """
        self._write(self._latest(changes, sequence, tie_break, across_loads))

    def delete_insert(self, rows: DataFrame) -> None:
        """Delete every stored row whose key occurs in ``rows``, then insert ``rows``.

        Unlike the other writes this one allows several rows per key.
        """
        self._write(self._latest(rows, [], True, False), unique=False)

    def apply_changes(
        self,
        changes: DataFrame,
        sequence: list[str],
        tie_break: bool = True,
        across_loads: bool = False,
    ) -> None:
        """Replay decoded changes, including deletes; see ``upsert``."""
        self._write(self._latest(changes, sequence, tie_break, across_loads))

    def rebucketed(self, spark: SparkSession, path: str, buckets: int, keep_deleted: bool = True) -> KeyedTable:
        """The same rows in a new table with another number of directories.

        Without ``keep_deleted``, keys that were deleted are forgotten; do so only once no
        change from before their deletion can come any more.
        """
        new = KeyedTable(path, self.schema, self.keys, buckets)
        rows = self.stored(spark)
        new._write(rows if keep_deleted else rows.where(~F.col(DELETED)), unique=False)
        return new

    def directories(self, spark: SparkSession) -> int | None:
        """The number of directories that keys are spread over; None before the first write."""
        names = Files(spark, self.path).directory_names(self.path)
        found = [n.split("=")[1] for n in names if n.startswith(f"{_OF}=")]
        return int(found[0]) if found else None

    # Writing

    def _latest(self, changes: DataFrame, sequence: list[str], tie_break: bool, ordered: bool) -> DataFrame:
        keys = list(self.keys)
        if ordered and sequence:
            return latest_changes(changes, keys, sequence, tie_break)
        latest = latest_per_key(changes, keys, sequence, tie_break) if sequence else changes
        marks = {ORDER: F.lit(None).cast("binary")}
        if DELETED not in changes.columns:
            marks[DELETED] = F.lit(False)
        return latest.withColumns(marks)

    def _write(self, changes: DataFrame, unique: bool = True) -> None:
        spark = changes.sparkSession
        self.finish(spark)
        known = self.directories(spark)
        of = known or self.buckets or _buckets_for(changes)
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(of)).cast("int")
        changes = changes.select(*self._conform(), ORDER, DELETED)
        changes = changes.withColumns({_OF: F.lit(of), _BUCKET: bucket})
        if not known:
            # Nothing to merge with, so one pass.
            _overwrite(changes.hint("rebalance", _BUCKET), self.path)
            return
        cached = changes.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # At most ``of`` values; this also fills the cache, whose size is then known.
            touched = [r[0] for r in cached.select(_BUCKET).distinct().collect()]
            if touched:
                merged = self._merged(cached, touched, unique)
                merged.write.mode("overwrite").partitionBy(_OF, _BUCKET).option(*_CODEC).parquet(self._merging)
                self.finish(spark)
        finally:
            cached.unpersist()

    def _merged(self, changes: DataFrame, touched: list[int], unique: bool) -> DataFrame:
        """New content of the touched directories. Every one of them has a row."""
        spark = changes.sparkSession
        keys = [_BUCKET, *self.keys]
        stored = self._read(spark, self.path).where(F.col(_BUCKET).isin(touched))
        few = _fits_broadcast(spark, changes.select(*keys))
        if not unique:
            # Many rows per key are possible: a join, as Spark can split a hot key of one.
            changed = changes.select(*keys).distinct()
            kept = stored.join(F.broadcast(changed) if few else changed, keys, "left_anti")
            return kept.select(*changes.columns).unionByName(changes).hint("rebalance", _BUCKET)
        if few:
            return merge_few(stored, changes, keys)
        # Gathered by directory before the merge, so that rows need no second shuffle to be written.
        slices = F.lit(_slices(spark, _size(stored) + _size(changes), len(touched)))
        part = F.pmod(F.hash(*self.keys), slices).alias(_SLICE)
        stored, changes = (df.select("*", part) for df in (stored, changes))
        return merge_ordered(stored, changes, keys, [_BUCKET, _SLICE]).drop(_SLICE)

    def finish(self, spark: SparkSession) -> None:
        """Put a merge in place that was written in full. Doing so twice changes nothing."""
        files = Files(spark, self.path)
        if files.exists(f"{self._merging}/_SUCCESS"):
            _overwrite(self._read(spark, self._merging), self.path)
            files.delete(self._merging)

    @property
    def _merging(self) -> str:
        return f"{self.path}_merging"

    def _conform(self) -> list[Column]:
        """Columns in the declared types; the hash of the key depends on them. No null keys."""
        columns = []
        for f in self.schema:
            column = F.col(f.name).cast(f.dataType)
            if f.name in self.keys:
                column = F.coalesce(column, F.raise_error(f"null key: {f.name}"))
            columns.append(column.alias(f.name))
        return columns

    def _read(self, spark: SparkSession, path: str) -> DataFrame:
        schema = StructType([*self.schema]).add(ORDER, "binary").add(DELETED, "boolean")
        schema = StructType([*schema, StructField(_OF, IntegerType()), StructField(_BUCKET, IntegerType())])
        if not Files(spark, path).directory_names(path):
            return empty_frame(spark, schema)
        return spark.read.schema(schema).parquet(path)


def _overwrite(df: DataFrame, path: str) -> None:
    """Replace the directories that ``df`` has rows for."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option(*_CODEC)
        .partitionBy(_OF, _BUCKET)
        .parquet(path)
    )


def _size(df: DataFrame) -> int:
    """The size in bytes that Spark knows for a frame, or assumes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _buckets_for(df: DataFrame) -> int:
    # For a join Spark assumes the product of both sides, so no more than is read for it.
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    size = min(_size(df), read)
    if size > _UNKNOWN:
        return DEFAULT_BUCKETS
    return max(1, -(-size // BUCKET_BYTES))


def _slices(spark: SparkSession, size: int, directories: int) -> int:
    """Into how many slices each directory is merged; no more than there are shuffle partitions."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions")) // directories
    return max(1, min(most, -(-size // (SLICE_BYTES * directories))))


def _fits_broadcast(spark: SparkSession, df: DataFrame) -> bool:
    """Whether the size Spark knows for a frame is under the session's broadcast threshold."""
    size = _size(df)
    return size <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
