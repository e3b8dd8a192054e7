"""Periodic runs of words, by longest common extensions over a difference cover.

A run is a stretch of words that repeats with a period at least four times and that no
neighbouring word extends. For each period p, the places i with equal words at i and i + p
form stretches, and those of a run are at least 3p long. So it is enough to look at every
3p-th place: this grid has n / 3p places for a period, and over all periods about
n * ln(n) / 3 (a harmonic sum). A place with equal words is extended to both sides.

How far two places agree is answered from a difference cover: of any V consecutive places
some are sampled (6 of 31), such that for any two places there is a shift below V that takes
both to sampled ones. Only the sampled suffixes are sorted; neighbours in that order have
their common length in a table of range minima. An extension compares fewer than V words
one by one and takes the rest from the table. Many documents are handled as one sequence,
with a word of its own after each.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.common import filled, slices

# A perfect difference set: each difference modulo V occurs.
V, COVER = 31, (0, 1, 3, 8, 12, 18)
REPEATS, LEAST = 4, 6
# Words handled at a time (a longer document is handled alone), and grid places.
WORDS, PLACES = 100_000, 1 << 18

FOUND = (
    "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
    "collapsed string"
)


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row with its runs and its text without the repeats: doc_id, n_words, runs, collapsed.

    Words are stretches without ASCII white space, numbered from 0. A run has the smallest
    period q that it can have, is at least max(6, 4q) words long and cannot be extended by a
    neighbouring word; runs are in order of start, then period. ``collapsed`` is the kept
    words joined by one space: a word goes if a run holds it after its first q words.

    Null texts, empty ones and those of white space have no words, no runs and an empty
    collapsed text. Rows without an id and repeated rows are rows like any other. An empty
    table gives no rows; other columns are not read.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), filled(text_col).alias("text"))
    return rows.mapInArrow(_find(), FOUND)


# Longest common extensions


class Extensions:
    """How many words from two places on are equal, for many pairs of places at once."""

    def __init__(self, words: np.ndarray):
        self.n = n = len(words)
        # Different words after the end, so that no comparison needs a bound.
        top = int(words.max()) + 1 if n else 0
        self.words = np.concatenate([words, top + np.arange(2 * V)]).astype(np.int32)
        in_cover = np.zeros(V, bool)
        in_cover[list(COVER)] = True
        self.samples = np.flatnonzero(in_cover[np.arange(n) % V])
        self.shift = self._shifts(in_cover)
        self._sort()

    @staticmethod
    def _shifts(in_cover: np.ndarray) -> np.ndarray:
        """The least shift that takes places of two remainders to sampled ones."""
        a, b, s = np.ogrid[:V, :V, :V]
        return (in_cover[(a + s) % V] & in_cover[(b + s) % V]).argmax(axis=2)

    def _sort(self) -> None:
        """Order the sampled suffixes: by their first V words, then by doubling lengths."""
        m, at = len(self.samples), self.samples
        self.index = np.full(self.n + V, -1, np.int64)
        self.index[at] = np.arange(m)
        blocks = np.lib.stride_tricks.sliding_window_view(self.words, V)[at] if m else np.zeros((0, V), np.int32)
        # Big-endian words, so that blocks compare as bytes.
        raw = np.ascontiguousarray(blocks.astype(">i4")).view(f"S{4 * V}").ravel()
        order = np.argsort(raw, kind="stable")
        levels = [self._ranks(order, raw[order])]
        step = V
        while m and levels[-1].max() < m - 1:
            rank = levels[-1]
            after = self._next(rank, step)
            key = rank * (m + 1) + after + 1
            order = np.argsort(key, kind="stable")
            levels.append(self._ranks(order, key[order]))
            step *= 2
        self.rank = levels[-1]
        self._minima(np.argsort(self.rank, kind="stable"), levels)

    @staticmethod
    def _ranks(order: np.ndarray, ordered: np.ndarray) -> np.ndarray:
        rank = np.zeros(len(order), np.int64)
        if len(order):
            rank[order[1:]] = np.cumsum(ordered[1:] != ordered[:-1])
        return rank

    def _next(self, rank: np.ndarray, step: int) -> np.ndarray:
        """Ranks of the suffixes ``step`` words later; -1 after the end."""
        later = self.samples + step
        out = np.full(len(rank), -1, np.int64)
        inside = later < self.n
        out[inside] = rank[self.index[later[inside]]]
        return out

    def _minima(self, order: np.ndarray, levels: list[np.ndarray]) -> None:
        """Common lengths of neighbours in the order, and their minima over powers of two."""
        a, b = self.samples[order[:-1]].copy(), self.samples[order[1:]].copy()
        length = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            rank, step = levels[k], V << k
            inside = (a < self.n) & (b < self.n)
            same = inside.copy()
            same[inside] = rank[self.index[a[inside]]] == rank[self.index[b[inside]]]
            length[same] += step
            a[same] += step
            b[same] += step
        live = np.flatnonzero((a < self.n) & (b < self.n))
        length = self._walk(a, b, live, np.full(len(live), V), length)
        self.table = [length.astype(np.int32)]
        half = 1
        while 2 * half <= len(length):
            last = self.table[-1]
            self.table.append(np.minimum(last[: len(last) - half], last[half:]))
            half *= 2

    def _walk(
        self, a: np.ndarray, b: np.ndarray, live: np.ndarray, most: np.ndarray, length: np.ndarray
    ) -> np.ndarray:
        """Add to lengths the equal words from a and b on, ``most`` at the most."""
        step = 0
        while len(live):
            go = (step < most) & (self.words[a[live] + step] == self.words[b[live] + step])
            live, most = live[go], most[go]
            length[live] += 1
            step += 1
        return length

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from places a and b on (different places, at most n)."""
        shift = self.shift[a % V, b % V]
        length = np.zeros(len(a), np.int64)
        self._walk(a, b, np.arange(len(a)), shift.copy(), length)
        x, y = a + shift, b + shift
        rest = np.flatnonzero((length == shift) & (x < self.n) & (y < self.n))
        i, j = self.rank[self.index[x[rest]]], self.rank[self.index[y[rest]]]
        low, high = np.minimum(i, j), np.maximum(i, j)
        level = np.frexp((high - low).astype(float))[1] - 1
        for k in np.unique(level):
            of = level == k
            least = self.table[k]
            found = np.minimum(least[low[of]], least[high[of] - (1 << int(k))])
            length[rest[of]] += found
        return length


# Runs


def grid(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (and periods) at which every run of some documents is met, in blocks."""
    most = sizes // REPEATS
    doc = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(LEAST, REPEATS * period) - period
    # A stretch of equal words as long as a step begins at 0 or later and ends before n - p.
    places = np.maximum(0, (sizes[doc] - period - 1) // step + 1)
    ends = np.cumsum(places)
    low = 0
    while low < len(doc):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + PLACES, "right")))
        part = slice(low, high)
        n = places[part]
        of = np.repeat(np.arange(low, high), n)
        within = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        yield starts[doc[of]] + within * step[of], period[of]
        low = high


def find_runs(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, length and period of all runs of documents that lie in one sequence of words.

    After each document the sequence has a word that occurs once.
    """
    found: list[np.ndarray] = []
    forward = back = None
    n = len(words)
    for at, period in grid(starts, sizes):
        equal = words[at] == words[at + period]
        at, period = at[equal], period[equal]
        if not len(at):
            continue
        if forward is None:
            forward, back = Extensions(words), Extensions(words[::-1].copy())
        right = forward.common(at, at + period)
        left = back.common(n - at, n - at - period)
        long = left + right + period >= np.maximum(LEAST, REPEATS * period)
        at, period, left, right = (x[long] for x in (at, period, left, right))
        found.append(np.stack([at - left, left + right + period, period]))
    if not found:
        return tuple(np.zeros((3, 0), np.int64))
    # A stretch may be met with multiples of its period too, and at several places.
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words no run holds after its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    return np.cumsum(edges)[:n] == 0


def _documents(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """The words of texts, of several texts at a time."""
    held, n = [], 0
    for text in texts:
        parts = text.as_py().encode("utf-8", "surrogatepass").split()
        held.append(parts)
        n += len(parts)
        if n >= WORDS:
            yield held
            held, n = [], 0
    if held:
        yield held


def _found(docs: list[list[bytes]]) -> Iterator[tuple[int, list[dict], bytes]]:
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(d) for d in docs])
    starts = np.cumsum(sizes + 1) - sizes - 1
    words = np.zeros(int(sizes.sum()) + len(docs), np.int64)
    for start, parts in zip(starts, docs):
        words[start : start + len(parts)] = [numbers[w] for w in parts]
    words[starts + sizes] = len(numbers) + np.arange(len(docs))
    start, length, period = find_runs(words, starts, sizes)
    low = np.searchsorted(start, starts)
    high = np.searchsorted(start, starts + sizes)
    for parts, base, i, j in zip(docs, starts, low, high):
        if i == j:
            yield len(parts), [], b" ".join(parts)
            continue
        s, n, p = start[i:j] - base, length[i:j], period[i:j]
        keep = kept_words(len(parts), s, n, p)
        runs = [
            {"start": a, "length": b, "period": c}
            for a, b, c in zip(s.tolist(), n.tolist(), p.tolist())
        ]
        yield len(parts), runs, b" ".join(compress(parts, keep.tolist()))


def _find() -> Callable:
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            done = 0
            for docs in _documents(batch["text"]):
                counts, runs, texts = zip(*_found(docs))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(done, len(docs)),
                        pa.array(counts, pa.int64()),
                        pa.array(runs, pa.list_(run)),
                        pa.array([t.decode("utf-8", "surrogatepass") for t in texts], pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )
                done += len(docs)

    return find
