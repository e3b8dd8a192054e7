"""One nested frame into several tables, and routing by variant."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ferryline.sinks.append import append_once, replace_batches

LOAD_ID = "load_id"


@dataclass(frozen=True)
class Child:
    """A target table and how its rows come out of the root frame."""

    table: str
    rows: Callable[[DataFrame], DataFrame]


def fan_out(
    roots: DataFrame, children: list[Child], root: Child, base: str, load_id: object = None
) -> None:
    """Write every child table, then the root table.

    Without one ``load_id`` for all, the frame and the rows of every table have a column of
    that name, such as a name for each source file, and each of its loads is replaced. Rows
    are written by the tasks that read them, so a task should hold few loads, as of files.

    The writes are separate jobs, so the root comes last and marks a whole document:
    a reader that takes only ids found in the root never sees half of one. Each write
    replaces its own load, so a repeated load does not duplicate rows. The frame is
    kept between the jobs, on disk where memory is short, to decode it once.
    """
    roots = roots.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        loads = []
        if load_id is None:  # as many as there are files
            loads = [row[0] for row in roots.select(LOAD_ID).distinct().collect()]
        for part in [*children, root]:
            rows, path = part.rows(roots), f"{base}/{part.table}"
            if load_id is None:
                replace_batches(rows, path, LOAD_ID, loads, gather=False)
            else:
                append_once(rows, path, load_id)
    finally:
        roots.unpersist()


def route(variant: str, targets: Mapping[str, str]) -> str:
    """The target database of a feed variant. An unknown variant is an error."""
    if variant not in targets:
        raise ValueError(f"variant {variant!r} is not one of {sorted(targets)}")
    return targets[variant]
