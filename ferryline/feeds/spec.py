"""What a feed is: source, columns, keys and write mode. One declaration, no code per feed."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimeType,
)

from ferryline.functions.text import snake_case

TYPES: dict[str, DataType] = {
    "string": StringType(),
    "bigint": LongType(),
    "int": IntegerType(),
    "smallint": ShortType(),
    "tinyint": ByteType(),
    "double": DoubleType(),
    "decimal": DecimalType(38, 10),
    "date": DateType(),
    "time": TimeType(3),
    "timestamp": TimestampNTZType(),
}

# What the control key of an end row begins with; a feed may name another.
END_PREFIX = "END_"

LINEAGE = {"import_id": "bigint", "batch_number": "string"}


@dataclass(frozen=True)
class Field:
    """One column: its name and type on the wire and in the target.

    A column that is read but not stored has no target.
    """

    source: str
    source_type: str
    target: str | None
    target_type: str

    @staticmethod
    def of(name: str, kind: str, stored: bool = True) -> Field:
        return Field(name, kind, snake_case(name) if stored else None, kind)


@dataclass(frozen=True)
class FeedSpec:
    code: str
    table: str
    database: str
    source: str
    mode: str
    fields: tuple[Field, ...]
    keys: tuple[str, ...] = ()
    lineage: tuple[str, ...] = ("import_id",)
    control_key: str | None = None
    end_prefix: str = END_PREFIX
    options: dict[str, object] = field(default_factory=dict)

    @property
    def source_schema(self) -> StructType:
        """As read. File readers know no time of day, so it is read as text and cast."""
        return StructType(
            [
                StructField(f.source, TYPES["string" if f.source_type == "time" else f.source_type])
                for f in self.fields
            ]
        )

    @property
    def stored(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if f.target is not None)

    @property
    def target_schema(self) -> StructType:
        columns = [StructField(f.target, TYPES[f.target_type]) for f in self.stored]
        return StructType(columns + [StructField(c, TYPES[LINEAGE[c]]) for c in self.lineage])

    def on_wire(self, name: Callable[[str], str] | Mapping[str, str]) -> FeedSpec:
        """The same feed with other field names on the wire, given by column name.

        A mapping may name some fields only; a function such as ``camel_case`` names all.
        """
        rename = name if callable(name) else lambda column: name.get(column, column)
        fields = tuple(replace(f, source=rename(f.source)) for f in self.fields)
        return replace(self, fields=fields)

    def location(self, base: str) -> str:
        return f"{base}/{self.database}/{self.table}"
