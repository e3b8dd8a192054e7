"""Tables whose schema is known only at run time, point lookups and key scans."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import CharType, StringType, VarcharType


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC scan.

    Without a partition column the whole table comes through one connection and one
    task, so a column and its bounds should be given for any large table. The bounds
    only shape the slices; rows outside them are still read.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column is not None:
        if bounds is None or partitions is None:
            raise ValueError("a partition column needs bounds and a number of partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


@dataclass(frozen=True)
class TableRef:
    """Where a table lives: ``parquet`` path, ``table`` in the catalog, or ``jdbc`` options.

    ``keys`` is its unique key, where it has one.
    """

    kind: str
    location: str = ""
    options: dict[str, str] = field(default_factory=dict)
    keys: tuple[str, ...] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        """The table with the schema it has now."""
        if self.kind == "parquet":
            df = spark.read.options(**self.options).parquet(self.location)
        elif self.kind == "table":
            df = spark.read.options(**self.options).table(self.location)
        elif self.kind == "jdbc":
            df = spark.read.format("jdbc").options(**self.options).load()
        else:
            raise ValueError(f"unknown kind of table: {self.kind}")
        return normalize_types(df)


def normalize_types(df: DataFrame) -> DataFrame:
    """Sized text types become STRING, so that source and target agree on one text type."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(StringType()).alias(f.name)
            if isinstance(f.dataType, (CharType, VarcharType))
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def point_lookup(df: DataFrame, key: str, value: object) -> Row:
    """The one row of a key, for the driver. The predicate is pushed to the scan.

    No row and several rows are errors.
    """
    rows = df.where(F.col(key) == F.lit(value)).limit(2).collect()
    if len(rows) != 1:
        raise LookupError(f"{'several rows' if rows else 'no row'} with {key} = {value!r}")
    return rows[0]


def loaded_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys already in a target: a scan of one column."""
    return df.select(key)
