"""Tables that follow a source whose schema changes between loads.

The declared schema of such a table is kept beside its files, one small file for each
change, and only ever widens. Files written before a change are not rewritten: Spark reads
them under the declared schema, converts narrower types and fills added columns with null.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)

from ferryline.sinks.paths import Files

# Each type with those that hold all its values and that Parquet files of it can be read as.
WIDER = {
    ByteType: (ShortType, IntegerType, LongType, DoubleType),
    ShortType: (IntegerType, LongType, DoubleType),
    IntegerType: (LongType, DoubleType),
    FloatType: (DoubleType,),
    DateType: (TimestampNTZType,),
}


class SchemaChanged(ValueError):
    """A source changed in a way that its copy cannot follow."""


def widens(narrow: DataType, wide: DataType) -> bool:
    """Whether every value of one type is one of the other, and files can be read so."""
    if isinstance(narrow, DecimalType) and isinstance(wide, DecimalType):
        more_scale = wide.scale - narrow.scale
        return more_scale >= 0 and wide.precision - narrow.precision >= more_scale
    return isinstance(wide, WIDER.get(type(narrow), ()))


def evolved(stored: StructType, found: StructType, keys: Iterable[str] = ()) -> StructType:
    """The schema that holds rows of both: stored columns in order, then the added ones.

    A column takes the wider of its two types. One that the source dropped stays, and is null
    in new rows. Names are compared as Spark does, without case. Any other change fails and
    names its column: types of which neither holds the other, nested types that differ,
    a changed or missing key, two columns with one name. A key keeps its type, as its hash
    says where a row is stored.
    """
    before, now = _by_name(stored), _by_name(found)
    for key in keys:
        old, new = before.get(key.lower()), now.get(key.lower())
        if new is None:
            raise SchemaChanged(f"key {key} is missing")
        if old is None or not _same(old.dataType, new.dataType):
            was = "no column" if old is None else old.dataType.simpleString()
            raise SchemaChanged(f"key {key} changed from {was} to {new.dataType.simpleString()}")
    columns = []
    for name, old in before.items():
        new = now.get(name)
        kind = old.dataType if new is None else _wider(old, new)
        columns.append(StructField(old.name, kind))
    columns += [StructField(new.name, new.dataType) for name, new in now.items() if name not in before]
    return StructType(columns)


def aligned(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows under a schema: columns in its order and types, null where ``df`` has none."""
    found = {name.lower(): name for name in df.columns}
    return df.select(
        *[
            (F.col(f"`{found[f.name.lower()]}`") if f.name.lower() in found else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def declared_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema that was last declared for a table; None before that."""
    names = Files(spark, path).file_names(_folder(path))
    versions = sorted(n for n in names if n.endswith(".json"))
    if not versions:
        return None
    text = spark.read.text(f"{_folder(path)}/{versions[-1]}", wholetext=True).first()[0]
    return StructType.fromJson(json.loads(text))


def follow(
    spark: SparkSession, path: str, found: StructType, keys: Iterable[str] = (), first: StructType | None = None
) -> StructType:
    """Declare what a table needs to hold rows of ``found`` as well; gives its schema.

    ``first`` is the schema of a table that was written before it had a declared one. The
    schema is declared before any row of it is written, so a load that fails after this
    leaves a table that reads as before, with an empty column at most.
    """
    declared = declared_schema(spark, path)
    stored = declared or first
    schema = evolved(stored if stored is not None else found, found, keys)
    if declared is None or _text(declared) != _text(schema):
        files = Files(spark, path)
        version = len([n for n in files.file_names(_folder(path)) if n.endswith(".json")])
        files.write_text(f"{_folder(path)}/{version:06d}.json", schema.json())
    return schema


def _folder(path: str) -> str:
    # Spark's scans leave out names with this prefix, but not when they are asked for.
    return f"{path}/_schema"


def _by_name(schema: StructType) -> dict[str, StructField]:
    named = {f.name.lower(): f for f in schema}
    if len(named) < len(schema):
        raise SchemaChanged(f"two columns have one name: {sorted(schema.names)}")
    return named


def _same(one: DataType, other: DataType) -> bool:
    return one.simpleString() == other.simpleString()


def _wider(old: StructField, new: StructField) -> DataType:
    if _same(old.dataType, new.dataType) or widens(new.dataType, old.dataType):
        return old.dataType
    if widens(old.dataType, new.dataType):
        return new.dataType
    raise SchemaChanged(
        f"column {old.name} changed from {old.dataType.simpleString()} to {new.dataType.simpleString()}"
    )


def _text(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]
