"""Dead letters: good and bad messages written from one decode."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ferryline.sources.messages import REASON, bad_messages, records_of


@dataclass(frozen=True)
class Counts:
    """Messages in all, and those of them that were set apart."""

    messages: int
    rejected: int


def land_apart(
    parsed: DataFrame,
    schema: StructType | ArrayType,
    write: Callable[[DataFrame], object],
    write_bad: Callable[[DataFrame], object],
    keep: list[str] | None = None,
    value: str = "value",
) -> Counts:
    """Write the bad messages of ``with_reasons`` with their reason, then the good records.

    The parsed messages are kept between the writes, on disk where memory is short, so each
    text is parsed once. The bad ones come first: once the records are there, so are the
    messages that have none. Both writers must bear being repeated, as in any load.
    """
    parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = parsed.agg(F.count(F.lit(1)), F.count(REASON)).first()
        write_bad(bad_messages(parsed, value, keep))
        write(records_of(parsed, schema, keep))
        return Counts(*counts)
    finally:
        parsed.unpersist()
