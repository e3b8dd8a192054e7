"""Projections, casts, lineage stamps and nesting."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = Callable[[DataFrame], DataFrame]


def map_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep, reorder and rename: ``{target: source}``. Other columns are not read at all."""
    return df.select(*[F.col(source).alias(target) for target, source in mapping.items()])


def rename_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    return df.toDF(*names)


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast columns. Strict casts fail on bad text, tolerant ones give null."""
    cast = Column.cast if strict else Column.try_cast
    return df.withColumns({name: cast(F.col(name), to) for name, to in types.items()})


def stamp(df: DataFrame, types: Mapping[str, str] | None = None, **values: object) -> DataFrame:
    """Add the same value to every row: import id, batch number, parent key."""
    types = types or {}
    return df.withColumns(
        {
            name: F.lit(value).cast(types[name]) if name in types else F.lit(value)
            for name, value in values.items()
        }
    )


def chain(df: DataFrame, steps: Iterable[Step | None]) -> DataFrame:
    """Apply steps in order; missing steps are skipped. No step is fine too."""
    return reduce(lambda frame, step: frame.transform(step), filter(None, steps), df)


def struct_rows(df: DataFrame, field: str, carry: Mapping[str, str] | None = None) -> DataFrame:
    """One row per record held in a struct column; rows without the record are dropped.

    ``carry`` adds parent columns: ``{name in result: column of the parent}``.
    """
    return df.where(F.col(field).isNotNull()).select(*_carried(carry), f"{field}.*")


def explode_children(
    df: DataFrame, field: str, carry: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per record in a list column. Parents with no children give no row."""
    return (
        df.select(*_carried(carry), F.explode(field).alias("_child"))
        .where(F.col("_child").isNotNull())
        .select(*(carry or {}), "_child.*")
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, frames)


def _carried(carry: Mapping[str, str] | None) -> list[Column]:
    return [F.col(source).alias(name) for name, source in (carry or {}).items()]
