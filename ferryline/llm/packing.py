"""Packing documents into sequences by best-two-fit.

The lengths are whole numbers up to the capacity, so all that decides a packing is how
many pieces there are of each length: at most ``capacity`` counts, whatever the number of
documents. The driver plans on those counts: a bin is filled greedily, then its smallest
piece is replaced by two unpacked ones if they fit the gap more tightly, and the pattern
found is used for as many bins as the counts allow. The pieces then get their number
among the pieces of their length, and with it their bin, in a join with the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.bpe import encoder
from ferryline.llm.common import filled, slices, staged

CAPACITY = 1024
END = 2

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long"
)


def pieces(
    df: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end: int = END,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Texts as token ids, cut only where longer than a sequence.

    Each text gets the id ``end`` after its own ids; null counts as empty. A longer one is
    cut from its end into pieces of full capacity, so only the first may be shorter.
    ``task`` and ``nth`` number the pieces of one length within a task. With ``with_ids``
    the ids come along.
    """
    if capacity < 1:
        raise ValueError("a sequence holds at least one token")
    schema = PIECES + (", ids array<int>" if with_ids else "")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), filled(text_col).alias("text"))
    return rows.mapInArrow(_cut(tokenizer, capacity, end, with_ids), schema)


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to the pieces of a staged table.

    Pieces of a sequence lie one after the other from 0. Lengths must be from 1 to the
    capacity. Equal pieces, repeated ids and null ids are packed like any other; an empty
    table gives no rows.
    """
    # A count for each task and length: the first number of each task's pieces.
    counts = found.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # At most ``capacity`` rows reach the driver.
    totals = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    slots = plan(totals, capacity)
    spark = found.sparkSession
    layout = spark.createDataFrame(
        pd.DataFrame(slots, columns=["length", "low", "high", "base", "at"]).astype("int64"),
        "length long, low long, high long, base long, at long",
    )
    numbered = found.join(starts.drop("n"), ["length", "task"]).withColumn(
        "rank", F.col("first") + F.col("nth")
    )
    # The plan's size is bounded by the capacity alone (see ``plan``), so it may be sent.
    placed = numbered.join(
        F.broadcast(layout),
        (numbered.length == layout.length)
        & (F.col("rank") >= F.col("low"))
        & (F.col("rank") < F.col("high")),
    )
    return placed.select(
        *[numbered[c] for c in found.columns if c not in ("task", "nth")],
        (F.col("base") + F.col("rank") - F.col("low")).alias("sequence_id"),
        F.col("at").alias("offset"),
    )


def packed(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """Cut and pack a table of texts; see ``pieces`` and ``pack``."""
    return pack(staged(pieces(df, tokenizer, capacity, **options), "pieces"), capacity)


def plan(totals: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, rank after the last, first sequence, offset).

    A pattern is used until one of its lengths has too few pieces left for it. What is
    left of that length is then less than its place in the pattern, at most capacity over
    length, so there are at most capacity + sum(capacity / length) patterns.
    """
    if any(not 1 <= size <= capacity for size in totals):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    left = np.zeros(capacity + 1, np.int64)
    for size, n in totals.items():
        left[size] = n
    used = np.zeros(capacity + 1, np.int64)
    slots, sequence = [], 0
    while left.any():
        pattern = _fill(left, capacity)
        sizes, times = np.unique(pattern, return_counts=True)
        bins = int((left[sizes] // times).min())
        left[sizes] -= bins * times
        at = 0
        for size in pattern:
            slots.append((size, int(used[size]), int(used[size]) + bins, sequence, at))
            used[size] += bins
            at += size
        sequence += bins
    return slots


def _fill(left: np.ndarray, capacity: int) -> list[int]:
    """The lengths of one bin, largest first, then bettered by one exchange for two."""
    free = left.copy()
    pattern, gap = [], capacity
    while gap:
        fitting = np.flatnonzero(free[: gap + 1])
        if not len(fitting):
            break
        size = int(fitting[-1])
        pattern.append(size)
        free[size] -= 1
        gap -= size
    smallest = pattern[-1]
    if gap and len(pattern) > 1:
        room = gap + smallest
        two = _pair(free, room)
        if two and sum(two) > smallest:
            pattern[-1:] = two
    return pattern


def _pair(free: np.ndarray, room: int) -> list[int] | None:
    """The two unpacked lengths with the largest sum that fits; the more uneven if equal."""
    large = np.flatnonzero(free[: room + 1])[::-1]
    if not len(large):
        return None
    # The largest available length that fits beside each.
    known = np.where(free[: room + 1] > 0, np.arange(room + 1), 0)
    below = np.maximum.accumulate(known)
    other = below[room - large]
    alone = (other == large) & (free[large] < 2)
    lower = below[np.maximum(large - 1, 0)]
    other = np.where(alone, np.where(lower <= room - large, lower, 0), other)
    sums = np.where(other > 0, large + other, 0)
    best = int(sums.argmax())
    return [int(large[best]), int(other[best])] if sums[best] else None


def _cut(tokenizer: str, capacity: int, end: int, with_ids: bool) -> Callable:
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        last = np.array([end], "<u4")
        for batch in slices(batches):
            rows, parts = [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = np.concatenate([encode(text.as_py()), last])
                n = len(ids)
                start, size, piece = 0, (n - 1) % capacity + 1, 0
                while start < n:
                    part = ids[start : start + size]
                    crc = zlib.crc32(part.tobytes())
                    rows.append((doc_id, piece, start, size, crc, task, seen[size]))
                    if with_ids:
                        parts.append(part.astype(np.int32))
                    seen[size] += 1
                    start, size, piece = start + size, capacity, piece + 1
            columns = zip(*rows) if rows else [[]] * len(names)
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            if with_ids:
                arrays.append(pa.array(parts, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

    return cut
