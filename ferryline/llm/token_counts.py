"""Token counts of the parts of documents, by the places of tokens in whole documents.

A document is encoded once, as a whole, since encoding its parts one by one would give
other tokens. Each token covers a span of the document; the sorted spans are joined with
the sorted spans of fields and of the sections in them, and a token that crosses a border
is allocated by a named rule.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.bpe import encoder
from ferryline.llm.common import filled, slices

# first: to the part with the token's first byte; last: with its last byte; most: to the
# part with most of its bytes, the earlier one if equal.
RULES = ("first", "last", "most")

COUNTS = "doc_id long, field string, section int, start long, stop long, n_tokens long, crossing long"


def count(
    df: DataFrame,
    tokenizer: str,
    fields: tuple[str, ...] = ("text",),
    rule: str = "most",
    between: str = "\n",
    id_col: str = "doc_id",
) -> DataFrame:
    """Tokens of each section of each field: one row for each section.

    A document is its fields in the order given, joined by ``between``; a section is a
    line of a field with its end. ``between`` counts as the end of the field before it, so
    the sections cover the document and their tokens add up to those of the document.
    ``start`` and ``stop`` are code points in the document; ``crossing`` is the number of
    tokens that touch the section and another one.

    Null fields are empty; an empty field is one section without tokens of its own.
    Repeated rows give repeated rows, a null id stays null, an empty table gives no rows.
    """
    if rule not in RULES:
        raise ValueError(f"the rule must be one of {RULES}")
    if not fields or len(set(fields)) < len(fields):
        raise ValueError("fields must be given, each once")
    texts = [filled(f"`{name}`").alias(f"f{i}") for i, name in enumerate(fields)]
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), *texts)
    return rows.mapInArrow(_count(tokenizer, fields, rule, between.encode()), COUNTS)


def sections(field: bytes) -> np.ndarray:
    """Where the lines of a field begin, in bytes."""
    breaks = np.flatnonzero(np.frombuffer(field, np.uint8) == 10) + 1
    return np.concatenate([[0], breaks[breaks < len(field)]])


def allocate(
    borders: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens, and crossing tokens, of each part between two neighbouring borders.

    Parts may be empty; tokens are in order, without gaps, and none is empty.
    """
    n = len(borders) - 1
    first = np.searchsorted(borders, starts, "right") - 1
    last = np.searchsorted(borders, stops, "left") - 1
    own = last if rule == "last" else first
    crossing = np.zeros(n, np.int64)
    across = np.flatnonzero(first != last)
    if len(across) and rule == "most":
        own = own.copy()
    for token in across:
        parts = np.arange(first[token], last[token] + 1)
        overlap = np.minimum(borders[parts + 1], stops[token]) - np.maximum(
            borders[parts], starts[token]
        )
        if rule == "most":
            own[token] = parts[overlap.argmax()]
        crossing[parts[overlap > 0]] += 1
    return np.bincount(own, minlength=n), crossing


def _count(tokenizer: str, fields: tuple[str, ...], rule: str, between: bytes) -> Callable:
    def one(texts: list[bytes]) -> tuple[np.ndarray, ...]:
        document = between.join(texts)
        begins, places, at = [], [], 0
        for i, text in enumerate(texts):
            lines = sections(text)
            begins.append(lines + at)
            places.append(np.stack([np.full(len(lines), i), np.arange(len(lines))]))
            at += len(text) + len(between)
        borders = np.concatenate([*begins, [len(document)]])
        code = encoder(tokenizer)
        stops = np.cumsum(code.byte_lengths[code.ids(document.decode())])
        starts = np.concatenate([[0], stops[:-1]]) if len(stops) else stops
        n_tokens, crossing = allocate(borders, starts, stops, rule)
        # Bytes to code points: bytes that continue a character do not count.
        heads = (np.frombuffer(document, np.uint8) & 0xC0) != 0x80
        points = np.concatenate([[0], np.cumsum(heads)])[borders]
        field, section = np.concatenate(places, axis=1)
        return field, section, points[:-1], points[1:], n_tokens, crossing

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(fields, object)
        for batch in slices(batches):
            if not batch.num_rows:
                continue
            columns = [[t.as_py().encode() for t in c] for c in batch.columns[1:]]
            made = [one(list(texts)) for texts in zip(*columns)]
            sizes = [len(m[0]) for m in made]
            field, section, *rest = (np.concatenate(c) for c in zip(*made))
            row = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
            arrays = [
                batch["doc_id"].take(row),
                pa.array(names[field], pa.string()),
                pa.array(section.astype(np.int32)),
                *[pa.array(c.astype(np.int64)) for c in rest],
            ]
            schema = ["doc_id", "field", "section", "start", "stop", "n_tokens", "crossing"]
            yield pa.RecordBatch.from_arrays(arrays, schema)

    return run
