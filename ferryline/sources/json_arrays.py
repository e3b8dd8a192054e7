"""JSON array files of any size and layout, read in splits.

Spark's text reader cuts files at closing braces, wherever its splits begin. Whether such a
piece begins inside a string, and how deep it is nested, follows from all text before it:
the number of quotes and of brackets outside strings. Within a split that is a running sum.
Over the splits of a file it is a running sum of their totals, of which there is one row each; as
a split does not know whether it begins inside a string, it counts brackets for both cases.
A split that is a whole file needs no totals. A piece that ends one level deep ends an element.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Decoder settings shared by every JSON source: raw control characters inside
# strings and NaN / Infinity are accepted.
JSON_OPTIONS = {"allowUnquotedControlChars": "true", "allowNonNumericNumbers": "true"}

# Where an element comes from: age and name of its file, and its place in it.
PLACE = ["_file_time", "_file", "_block", "_row"]

_SPLIT = ["_file", "_block"]
_OF_SPLIT = ["_file", "_time", "_block", "begins_inside", "begins_depth", "_alone"]
_PLACED = ["value", "_row", *_OF_SPLIT]
_TOTALS = (
    StructType().add("_file", "string").add("_block", "long")
    .add("quotes", "long").add("from_outside", "long").add("from_inside", "long")
)
_PARTS = (
    StructType().add("_time", "long").add("_file", "string").add("_block", "long").add("_row", "long")
    .add("_text", "string").add("begins", "boolean").add("ends", "boolean").add("alone", "boolean")
)
_ARROW_TOTALS, _ARROW_PARTS = to_arrow_schema(_TOTALS), to_arrow_schema(_PARTS)
_ESCAPED = re.compile(r"\\.", re.DOTALL)
_ARRAY = re.compile(r"[ \t\n\x0b\f\r]*\[")
# What may stand before an element, and what may stand where one would after the last.
_BEFORE = r"^\s*[\[,]?\s*(null\s*,\s*)*"
_END = r"^\s*\[?\s*,?\s*(null\s*,\s*)*(null\s*)?\]\s*\}$"


def json_array_splits(
    spark: SparkSession, path: str | list[str], schema: StructType, place: bool = False
) -> DataFrame:
    """The elements of JSON arrays of objects, one array a file, as rows.

    A file may be laid out in any way, on one line or many, and of any size: splits of it
    are read by tasks of their own, which go through a split's pieces in order and hold one
    element at a time. Null elements are left out. A file that is no array, is cut off, or has
    an element that is no object or does not fit the schema, fails. With ``place`` the columns
    PLACE say where an element stands; they order the elements of all files. Tasks go through
    text once, through that of files with several splits three times; only elements that go
    over the border of splits are shuffled.
    """
    pieces = _pieces(spark, path)
    elements = _elements(pieces, _offsets(pieces))
    text = F.regexp_replace("_text", _BEFORE, "")
    is_object = F.when(text.startswith("{"), text).otherwise(
        F.raise_error(F.concat(F.lit("not an array of objects: "), "_file"))
    )
    parsed = F.from_json(is_object, schema, {"mode": "FAILFAST", **JSON_OPTIONS})
    return elements.select(parsed.alias("_r"), *(PLACE if place else [])).select(
        "_r.*", *(PLACE if place else [])
    )


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text up to each closing brace. A split is read by one task, in order."""
    return spark.read.option("lineSep", "}").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.unix_micros("_metadata.file_modification_time").alias("_time"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        (F.col("_metadata.file_block_length") == F.col("_metadata.file_size")).alias("_alone"),
    )


def _strings(piece: str) -> list[str]:
    """A piece cut at its quotes: every other part is a string.

    No escape reaches over the end of a piece, as a brace is never escaped.
    """
    if "\\" in piece:
        piece = _ESCAPED.sub("", piece)
    return piece.split('"')


def _opened(strings: list[str], inside: int) -> int:
    """How many more brackets open than close outside strings, if the piece begins so."""
    text = "".join(strings[inside::2])
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _brace(inside: int) -> int:
    """The brace after a piece counts if the piece does not end in a string."""
    return 0 if inside % 2 else 1


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of batches cut where another split begins."""
    for batch in batches:
        differ = [pc.not_equal(c[1:], c[:-1]) for c in (batch.column(n) for n in _SPLIT)]
        borders = np.flatnonzero(pc.or_(*differ).to_numpy(zero_copy_only=False)) + 1
        for start, end in pairwise([0, *borders.tolist(), batch.num_rows]):
            yield batch.slice(start, end - start)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a split: its quotes, and how much deeper it ends, for both cases of its start."""
    split, quotes, deeper = None, 0, [0, 0]

    def total() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [dict(zip(_TOTALS.names, [*split, quotes, *deeper]))], _ARROW_TOTALS
        )

    for run in _runs(batches):
        found = tuple(run.column(c)[0].as_py() for c in _SPLIT)
        if found != split:
            if split is not None:
                yield total()
            split, quotes, deeper = found, 0, [0, 0]
        for value in run.column("value").to_pylist():
            strings = _strings(value)
            count = len(strings) - 1
            for start in (0, 1):
                inside = (start + quotes) % 2
                deeper[start] += _opened(strings, inside) - _brace(inside + count)
            quotes += count
    if split is not None:
        yield total()


def _offsets(pieces: DataFrame) -> DataFrame:
    """For each split of a file with several, whether it begins inside a string, and how deep."""
    several = pieces.where(~F.col("_alone"))
    totals = several.select("value", "_file", "_block").mapInArrow(_totals, _TOTALS)
    order = Window.partitionBy("_file").orderBy("_block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.withColumn("begins_inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    begins = begins.withColumn(
        "deeper", F.when(F.col("begins_inside") == 1, F.col("from_inside")).otherwise(F.col("from_outside"))
    )
    depth = F.coalesce(F.sum("deeper").over(before), F.lit(0))
    # The last piece, which ends the array, has no brace after it but counts as if it had.
    file = Window.partitionBy("_file")
    whole = F.sum("deeper").over(file)
    whole_depth = F.when(whole == -1, depth).otherwise(
        F.raise_error(F.concat(F.lit("not a whole JSON array: "), "_file"))
    )
    return begins.select(*_SPLIT, "begins_inside", whole_depth.alias("begins_depth"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements of each split, in order: what stands in it of each of them."""
    split, part, texts, done = None, None, [], []
    whole, depth = False, 0

    def end() -> None:
        if part is not None:
            done.append(part | {"_text": "}".join(texts) + "}"})

    def close() -> None:
        # The last piece, which ends the array, has no brace after it but counts as if it had.
        if whole and depth != -1:
            raise ValueError(f"not a whole JSON array: {split[0]}")
        end()

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(done, _ARROW_PARTS)

    for run in _runs(batches):
        file, time, block, begins_inside, begins_depth, alone = (run.column(c)[0].as_py() for c in _OF_SPLIT)
        if (file, block) != split:
            close()
            split, part, whole = (file, block), None, alone
            inside, depth = begins_inside, begins_depth
        for value, number in zip(run.column("value").to_pylist(), run.column("_row").to_pylist()):
            if depth < 0 or (depth == 0 and not _ARRAY.match(value)):
                raise ValueError(f"not a JSON array: {file}")
            begins = depth <= 1
            if begins or part is None:
                end()
                part, texts = dict(zip(_PARTS.names, [time, file, block, number, None, begins, False, alone])), []
            texts.append(value)
            strings = _strings(value)
            depth += _opened(strings, inside)
            inside = (inside + len(strings) - 1) % 2
            depth -= _brace(inside)
            part["ends"] = part["ends"] or depth == 1
        if done:
            yield made()
            done.clear()
    close()
    if done:
        yield made()


def _elements(pieces: DataFrame, offsets: DataFrame) -> DataFrame:
    """The text of each element, with its place. Only those at borders of splits are shuffled."""

    def parts(placed: DataFrame) -> DataFrame:
        found = placed.select(*_PLACED).mapInArrow(_parts, _PARTS)
        return found.withColumn("_file_time", F.timestamp_micros("_time"))

    # One row a split, so that tasks go on reading it in order.
    begins = F.broadcast(offsets)
    whole_files = F.col("_alone")
    start = {c: F.when(whole_files, 0).otherwise(F.col(c)).cast("long") for c in ("begins_inside", "begins_depth")}
    placed = pieces.join(begins, _SPLIT, "left").withColumns(start)
    whole = F.col("begins") & F.col("ends")
    # Where no element ends there is the end of the array.
    odd = F.col("alone") & ~F.col("_text").rlike(_END)
    columns = [*PLACE, "_text"]
    inner = parts(placed).where(whole | odd).select(*columns)
    return inner.unionByName(_joined(parts(pieces.where(~whole_files).join(begins, _SPLIT)).where(~whole)))


def _joined(parts: DataFrame) -> DataFrame:
    """Elements that go over the border of splits, of which a split has at most two parts."""
    order = Window.partitionBy("_file").orderBy("_block", "_row")
    number = F.count_if("begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
    part = F.struct("_block", "_row", "_text")
    joined = parts.withColumn("number", number).groupBy("_file", "number").agg(
        F.first("_file_time").alias("_file_time"),
        F.array_sort(F.collect_list(part)).alias("parts"),
        F.max("ends").alias("ends"),
    )
    joined = joined.select(
        "_file_time",
        "_file",
        F.element_at("parts", 1)["_block"].alias("_block"),
        F.element_at("parts", 1)["_row"].alias("_row"),
        F.array_join(F.transform("parts", lambda p: p["_text"]), "").alias("_text"),
        "ends",
    )
    # Where no element ends there is the end of the array.
    return joined.where(F.col("ends") | ~F.col("_text").rlike(_END)).drop("ends")
