"""Joins against landed tables.

No side is broadcast by hand: Spark broadcasts a side whose measured size is under
the threshold, and otherwise shuffles and splits skewed keys at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.operators.project import explode_children


def new_keys_only(remote: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Offered rows whose key is not loaded yet.

    Loaded keys are made distinct within each task first, so a key on very many loaded
    rows, such as a date, travels once per task.
    """
    return remote.join(loaded.select(*keys).distinct(), keys, "left_anti")


def parent_children(
    parents: DataFrame,
    payloads: DataFrame,
    keys: list[str],
    records: str | None = None,
    missing: str = "fail",
) -> DataFrame:
    """Children of every parent. ``records`` names a list column to unpack into rows.

    A parent without a payload fails the read, or is left out with ``missing="skip"``.
    """
    joined = _found(parents, payloads, keys, missing)
    if records is None:
        return joined
    carry = {c: c for c in joined.columns if c != records}
    return explode_children(joined, records, carry)


def lookup_chain(df: DataFrame, *steps: tuple[DataFrame, list[str]]) -> DataFrame:
    """Follow keys through several tables, such as date to plan code to document."""
    for table, keys in steps:
        df = df.join(table, keys)
    return df


def _found(parents: DataFrame, others: DataFrame, keys: list[str], missing: str) -> DataFrame:
    if missing == "skip":
        return parents.join(others, keys)
    if missing != "fail":
        raise ValueError("missing must be 'fail' or 'skip'")
    joined = parents.join(others.withColumn("_found", F.lit(True)), keys, "left")
    told = F.concat(F.lit("nothing landed for "), F.to_json(F.struct(*keys)))
    # A filter, so that it is checked whichever columns are used later.
    return joined.where(F.coalesce("_found", F.raise_error(told).cast("boolean"))).drop("_found")


def first_child(
    parents: DataFrame, children: DataFrame, keys: list[str], records: str, missing: str = "fail"
) -> DataFrame:
    """Parents with the first element of their child list.

    A parent whose list is empty is an error, as there is no first element. So is one
    without a list, unless ``missing="skip"`` leaves it out.
    """
    first = F.coalesce(
        F.get(records, F.lit(0)), F.raise_error("a parent has an empty child list")
    )
    return _found(parents, children, keys, missing).withColumn("_first", first).drop(records).select(
        *parents.columns, "_first.*"
    )
