"""Compaction of landed micro-batches: many small loads of a stream become one.

A stream lands each micro-batch as a load of its own, named by query and number, so that a
repeated one replaces itself. All but the newest loads of a query are closed: they will not be
delivered again. They are rewritten as one load, whose name says up to which number it goes.
It counts once Spark has committed it as a whole; from then on loads up to that number are
not read, and not written again, whether or not they have been deleted yet.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ferryline.sinks.append import empty_frame
from ferryline.sinks.loads import LOAD_ID, SINGLE, THROUGH, counting_loads
from ferryline.sinks.paths import Files

def read_landed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of a landed table, each once, before, during and after a compaction."""
    counting, _ = counting_loads(Files(spark, path), path)
    if not counting:
        return empty_frame(spark, schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*[f"{path}/{name}" for name in counting]).select(*schema.names)


def compact_loads(
    spark: SparkSession,
    path: str,
    schema: StructType,
    order: list[str] | None = None,
    open_loads: int = 1,
) -> dict[str, int]:
    """Rewrite the closed loads of each query as one; gives the number each now goes to.

    With ``order`` (a time, say) rows are spread over files by ranges of these columns and
    sorted, so that a later cut by them reads few files and row groups. The newest
    ``open_loads`` loads of a query stay apart. Loads that no number tells, as those of files,
    stay as they are. A run that was cut off has no effect but files that the next removes.
    """
    if open_loads < 1:
        raise ValueError("the newest load of a stream may be delivered again")
    files = Files(spark, path)
    counting, through = counting_loads(files, path)
    singles: dict[str, list[int]] = defaultdict(list)
    for name in counting:
        if (single := SINGLE.match(name)) and not THROUGH.match(name):
            singles[single[1]].append(int(single[2]))
    for query, numbers in singles.items():
        closed = sorted(numbers)[:-open_loads]
        if not closed:
            continue
        parts = [f"{LOAD_ID}={query}-{n}" for n in closed]
        if query in through:
            parts.append(f"{LOAD_ID}={query}-through-{through[query]}")
        inside = StructType([f for f in schema if f.name != LOAD_ID])
        rows = spark.read.schema(inside).parquet(*[f"{path}/{p}" for p in parts])
        if order:
            rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        else:
            rows = rows.hint("rebalance")
        rows.write.mode("overwrite").parquet(f"{path}/{LOAD_ID}={query}-through-{closed[-1]}")
        through[query] = closed[-1]
    # What does not count now is part of a compacted load, or left from a run cut off.
    counting, through = counting_loads(files, path)
    for name in set(files.directory_names(path)) - set(counting):
        if name.startswith(f"{LOAD_ID}="):
            files.delete(f"{path}/{name}")
    return through
