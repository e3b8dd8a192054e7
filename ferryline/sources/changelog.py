"""Change records: an operation with the row before and after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ferryline.sources.files import JSON_OPTIONS

# Operation codes of change records (snapshot read, create, update, delete).
OPERATIONS = ("r", "c", "u", "d")

DELETED = "_deleted"


def change_schema(row: StructType) -> StructType:
    return StructType(
        [StructField("op", StringType()), StructField("before", row), StructField("after", row)]
    )


def decode_changes(df: DataFrame, row: StructType, value: str, sequence: list[str]) -> DataFrame:
    """Change messages to rows plus a delete mark.

    A delete carries the key in ``before``, everything else the new row in ``after``.
    ``sequence`` names the columns that order the changes of one key. A null value, which
    a topic may hold after a delete, is no change; blank text fails.
    """
    df = df.where(F.col(value).isNotNull())
    change = F.from_json(F.col(value), change_schema(row), {"mode": "FAILFAST", **JSON_OPTIONS})
    known = F.when(F.col("_c.op").isin(*OPERATIONS), F.col("_c.op")).otherwise(
        F.raise_error(
            F.concat(F.lit("unknown change operation: "), F.coalesce("_c.op", F.lit("none")))
        )
    )
    return (
        df.select(*sequence, change.alias("_c"))
        .select(*sequence, "_c", (known == "d").alias(DELETED))
        .select(
            *sequence,
            DELETED,
            F.when(F.col(DELETED), F.col("_c.before")).otherwise(F.col("_c.after")).alias("_r"),
        )
        .select(*sequence, DELETED, "_r.*")
    )


def snapshot_changes(rows: DataFrame, position: dict[str, Column]) -> DataFrame:
    """Rows of a snapshot as changes, placed at the log position they were read at.

    ``position`` gives the columns of the log's sequence. A part of a snapshot that was read
    while the log stood at a position holds all changes up to it, so its rows count over
    these and lose to later ones, whichever of the two is written first. Parts of a large
    snapshot, read one after another, have a position each. A row that was deleted before
    its part was read is in neither; one deleted later comes with the log.
    """
    return rows.select(*[c.alias(n) for n, c in position.items()], F.lit(False).alias(DELETED), "*")
