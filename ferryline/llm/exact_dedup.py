"""Exact duplicates by content sort.

Rows are range-partitioned by sampled splitters over the normalised text, sorted on
disk if need be, and each text is compared in full with the one before it. The place of
a row in the order also depends on its id, so the copies of one text, however many, are
spread over as many partitions as they fill. A run of equal texts that reaches the edge
of its partition is then joined with the runs at the edges of the others; there are at
most two such runs for each partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ferryline.llm.common import filled, slices, staged

SPACE = r"[\x20\x09-\x0D]+"
# Splitters are sampled from this many leading characters, the digest and the id, so
# that a sample of very long texts stays small. The sort compares whole texts.
SPLITTER_CHARS = 32


def normalised(text: str) -> Column:
    """The text with each run of ASCII white space replaced by one space; null is empty."""
    return F.regexp_replace(filled(text), SPACE, " ")


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with the group of equal texts it belongs to.

    Returns doc_id, keep_id (the smallest id of the group), group_size, kept (true for one
    row of each group, the first by id) and text_sha256. Ids that are null come last and
    are kept only in a group without other ids, where keep_id is null. Of repeated rows
    with one id, one is kept. Null and empty texts are equal. An empty table gives no
    rows. Other columns are not read.
    """
    runs = _runs(df.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("norm")), [])
    return _merged(runs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows of ``groups`` with all their columns, unchanged."""
    carried = [f"c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*carried)
    key, text = (carried[df.columns.index(c)] for c in (id_col, text_col))
    rows = plain.select(F.col(key).alias("doc_id"), normalised(text).alias("norm"), *carried)
    kept = _merged(_runs(rows, carried)).where("kept")
    return kept.select(*carried).toDF(*df.columns)


def _runs(rows: DataFrame, carried: list[str]) -> DataFrame:
    """Rows with their run of equal texts in their partition."""
    place = F.substring("norm", 1, SPLITTER_CHARS)
    rows = rows.withColumn("digest", F.unhex(F.sha2("norm", 256)))
    last = F.col("doc_id").asc_nulls_last()
    ordered = rows.repartitionByRange(place, "digest", last).sortWithinPartitions(
        place, "digest", "norm", last
    )
    key = rows.schema["doc_id"]
    schema = StructType([key])
    schema.add("digest", "binary").add("place", "long").add("first", key.dataType)
    schema.add("size", "long").add("run", "long").add("norm", "string")
    for name in carried:
        schema.add(name, rows.schema[name].dataType)
    return staged(ordered.mapInArrow(_compare(carried), schema), "runs")


def _merged(runs: DataFrame) -> DataFrame:
    """Runs of one text at the edges of partitions become one group.

    Only the rows of such runs are joined, by their run; all others stay where they lie.
    """
    inside, at_edge = runs.where("run is null"), runs.where("run is not null")
    heads = at_edge.where("place = 0").select("run", "norm", "first", "size")
    whole = heads.groupBy("norm").agg(
        F.min("first").alias("whole_first"),
        F.sum("size").alias("whole_size"),
        F.min("run").alias("first_run"),
    )
    edges = heads.join(whole, "norm").select("run", "whole_first", "whole_size", "first_run")
    own = {
        "keep_id": F.col("first"),
        "group_size": F.col("size"),
        "kept": F.col("place") == 0,
    }
    shared = {
        "keep_id": F.col("whole_first"),
        "group_size": F.col("whole_size"),
        "kept": (F.col("place") == 0) & (F.col("first_run") == F.col("run")),
    }
    columns = [c for c in runs.columns if c not in ("digest", "norm")]
    digest = F.lower(F.hex("digest")).alias("text_sha256")

    def of(rows: DataFrame, made: dict[str, Column]) -> DataFrame:
        return rows.select(*columns, *[c.alias(n) for n, c in made.items()], digest)

    return of(inside, own).unionByName(of(at_edge.join(edges, "run"), shared))


def _compare(carried: list[str]) -> Callable:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Compare each text with the one before it; emit runs once they are complete.

        Of an open run only the ids and its first row are held.
        """
        part = TaskContext.get().partitionId()
        head: pa.RecordBatch | None = None
        ids: list[pa.Array] = []
        done = 0

        def emit(row: pa.RecordBatch, doc_ids: pa.Array, run: int | None) -> pa.RecordBatch:
            n = len(doc_ids)
            at = pa.array([0] + [None] * (n - 1), pa.int64())
            columns = [
                doc_ids,
                row["digest"].take(pa.array(np.zeros(n, np.int64))),
                pa.array(np.arange(n)),
                doc_ids.take(pa.array(np.zeros(n, np.int64))),
                pa.array(np.full(n, n)),
                pa.array([run] * n, pa.int64()),
                row["norm"].take(at) if run is not None else pa.nulls(n, row["norm"].type),
                *[row[c].take(at) for c in carried],
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        def inner(batch: pa.RecordBatch, starts: np.ndarray, end: int) -> pa.RecordBatch:
            """Runs that begin and end in one batch and touch no edge."""
            begin = int(starts[0])
            sizes = np.diff(np.append(starts, end))
            first = np.repeat(starts, sizes)
            index = np.arange(begin, end)
            is_head = index == first
            rows = batch.slice(begin, end - begin)
            at = pa.array(index - begin, mask=~is_head)
            columns = [
                rows["doc_id"],
                rows["digest"],
                pa.array(index - first),
                batch["doc_id"].take(pa.array(first)),
                pa.array(np.repeat(sizes, sizes)),
                pa.nulls(len(rows), pa.int64()),
                pa.nulls(len(rows), rows["norm"].type),
                *[rows[c].take(at) for c in carried],
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        names = ["doc_id", "digest", "place", "first", "size", "run", "norm", *carried]
        for batch in slices(batches):
            n = batch.num_rows
            if not n:
                continue
            text = batch["norm"]
            new = np.ones(n, bool)
            if n > 1:
                same = pc.equal(text.slice(1), text.slice(0, n - 1))
                new[1:] = ~same.to_numpy(zero_copy_only=False)
            if head is not None:
                new[0] = text[0].as_py() != head["norm"][0].as_py()
            starts = np.flatnonzero(new)
            if head is not None and len(starts):
                ids.append(batch["doc_id"].slice(0, int(starts[0])))
                yield emit(head, pa.concat_arrays(ids), None if done else 2 * part)
                done, head = done + 1, None
            if head is None:
                if not done and len(starts) > 1:  # the first run of the partition
                    stop = int(starts[1])
                    yield emit(batch.slice(0, 1), batch["doc_id"].slice(0, stop), 2 * part)
                    done, starts = 1, starts[1:]
                if len(starts) > 1:
                    yield inner(batch, starts[:-1], int(starts[-1]))
                    done += len(starts) - 1
                at = int(starts[-1])
                head, ids = batch.slice(at, 1), [batch["doc_id"].slice(at)]
            else:
                ids.append(batch["doc_id"])
        if head is not None:
            yield emit(head, pa.concat_arrays(ids), 2 * part + 1)

    return compare
