"""Names of the loads of a landed table, and which of them count."""

from __future__ import annotations

import re

from ferryline.sinks.paths import Files

LOAD_ID = "load_id"
SINGLE = re.compile(rf"{LOAD_ID}=(.+)-(\d+)$")
THROUGH = re.compile(rf"{LOAD_ID}=(.+)-through-(\d+)$")


def counting_loads(files: Files, path: str) -> tuple[list[str], dict[str, int]]:
    """The directories that count, and for each query the number its compacted load goes to."""
    names = [n for n in files.directory_names(path) if n.startswith(f"{LOAD_ID}=")]
    through: dict[str, int] = {}
    for name in names:
        made = THROUGH.match(name)
        if made and files.exists(f"{path}/{name}/_SUCCESS"):
            through[made[1]] = max(through.get(made[1], -1), int(made[2]))
    counting = []
    for name in names:
        made, single = THROUGH.match(name), SINGLE.match(name)
        if made:
            counts = through.get(made[1]) == int(made[2])
        else:
            counts = not single or int(single[2]) > through.get(single[1], -1)
        if counts:
            counting.append(name)
    return counting, through


def is_compacted(files: Files, path: str, load_id: object) -> bool:
    """Whether a load is part of a compacted one, and must not be written again."""
    single = SINGLE.match(f"{LOAD_ID}={load_id}")
    return bool(single) and int(single[2]) <= counting_loads(files, path)[1].get(single[1], -1)
