"""Language identification by rank-order profiles.

A language's profile is its most frequent letter n-grams (one to three letters, with word
ends) in order. A text's own most frequent n-grams are compared with each profile: each
n-gram costs the distance between its two ranks, or the profile's size if it is missing
there. The nearest profile names the language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.common import filled, slices

UNKNOWN = "und"
PROFILE = 400
# Profiles go to every task; more languages than this are refused.
MAX_LANGUAGES = 1000
_CHUNK = 400_000
_SPACE = 32
_SHIFT = 21


@dataclass(frozen=True)
class Profiles:
    """Ranks of n-grams by language: ranks[i, j] is the rank of grams[j] in languages[i]."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    size: int


def learn(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE
) -> Profiles:
    """Profiles of every language in the rows whose language is not null.

    Counts cover whole texts; null texts count for nothing. N-grams of equal count are
    ordered by code point. Without rows, or letters in them, no language is known.
    """
    rows = df.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), filled(text_col).alias("text")
    )
    counts = rows.mapInArrow(_count, "lang string, gram long, n long")
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    # ``size`` rows for each language reach the driver.
    found = best.limit(size * MAX_LANGUAGES + 1).toPandas()
    if len(found) > size * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(found["lang"].unique())
    grams = np.unique(found["gram"].to_numpy(np.int64))
    ranks = np.full((len(languages), len(grams)), -1, np.int64)
    row = {name: i for i, name in enumerate(languages)}
    at = np.searchsorted(grams, found["gram"].to_numpy(np.int64))
    ranks[[row[name] for name in found["lang"]], at] = found["rank"].to_numpy() - 1
    return Profiles(languages, grams, ranks, size)


def identify(df: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """Add lang_pred and score to every row; columns of these names are replaced.

    The score is 1 less the mean distance of the text's n-grams over the largest one
    possible. Null texts, texts without letters, and all texts if no profile is known get
    ``und`` and 0. Of equally near languages the first by name is taken.
    """
    kept = [c for c in df.columns if c not in ("lang_pred", "score")]
    plain = df.select(*kept)
    names = [f"c{i}" for i in range(len(kept))]
    given = plain.toDF(*names).withColumn("t", filled(names[kept.index(text_col)]))
    schema = given.drop("t").schema.add("lang_pred", "string").add("score", "double")
    return given.mapInArrow(_predict(profiles), schema).toDF(*kept, "lang_pred", "score")



@cache
def _letters() -> np.ndarray:
    """Lower-case code point of each letter, and a space for all else."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


def letters(text: str) -> np.ndarray:
    """Code points of a text's words, each with a space before it, and one at the end."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate([[_SPACE], _letters()[codes], [_SPACE]]).astype(np.int64)
    blank = codes == _SPACE
    return codes[~(blank & np.concatenate([[False], blank[:-1]]))]


def count_grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of ``letters`` in order of code points, and how often each occurs."""
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    alphabet = np.flatnonzero(np.bincount(codes))
    n = len(alphabet)
    if n > 128:  # too many for a table of all triples
        one, two = codes[codes != _SPACE], codes[:-1] << _SHIFT | codes[1:]
        three = (two[:-1] << _SHIFT | codes[2:])[codes[1:-1] != _SPACE]
        return np.unique(np.concatenate([one, two, three]), return_counts=True)
    dense = np.zeros(int(alphabet[-1]) + 1, np.int64)
    dense[alphabet] = np.arange(n)
    at = dense[codes]
    pairs = at[:-1] * n + at[1:]
    one, two = np.bincount(at, minlength=n), np.bincount(pairs, minlength=n * n)
    three = np.bincount(pairs[:-1] * n + at[2:], minlength=n * n * n)
    # The space is the smallest code, so its place is 0.
    i1 = np.flatnonzero(one[1:]) + 1
    i2 = np.flatnonzero(two)
    i3 = np.flatnonzero(three)
    i3 = i3[i3 // n % n != 0]
    grams = np.concatenate(
        [
            alphabet[i1],
            alphabet[i2 // n] << _SHIFT | alphabet[i2 % n],
            (alphabet[i3 // (n * n)] << _SHIFT | alphabet[i3 // n % n]) << _SHIFT
            | alphabet[i3 % n],
        ]
    )
    return grams, np.concatenate([one[i1], two[i2], three[i3]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts by language, summed within the task; the store is emptied when full."""
    waiting: dict[str, list[np.ndarray]] = {}
    length: dict[str, int] = {}
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang: str) -> None:
        grams, counts = count_grams(np.concatenate(waiting.pop(lang)))
        length.pop(lang)
        if lang in sums:
            both = np.concatenate([sums[lang][0], grams])
            grams, at = np.unique(both, return_inverse=True)
            counts = np.bincount(at, np.concatenate([sums[lang][1], counts]), len(grams))
        sums[lang] = grams, counts.astype(np.int64)

    def emptied() -> Iterator[pa.RecordBatch]:
        for lang, (grams, counts) in sums.items():
            columns = [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])
        sums.clear()

    for batch in slices(batches):
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
            codes = letters(text.as_py())
            waiting.setdefault(lang, []).append(codes)
            length[lang] = length.get(lang, 0) + len(codes)
            if length[lang] >= _CHUNK:
                add(lang)
        if sum(map(len, (s[0] for s in sums.values()))) > 1_000_000:
            yield from emptied()
    for lang in list(waiting):
        add(lang)
    yield from emptied()


def _predict(profiles: Profiles) -> Callable:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [nearest(text.as_py(), profiles) for text in batch["t"]]
            columns = batch.columns[:-1] + [
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ]
            names = batch.schema.names[:-1] + ["lang_pred", "score"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return predict


def nearest(text: str, profiles: Profiles) -> tuple[str, float]:
    grams, counts = count_grams(letters(text))
    if not len(grams) or not profiles.languages:
        return UNKNOWN, 0.0
    top = grams[np.argsort(-counts, kind="stable")[: profiles.size]]
    at = np.minimum(np.searchsorted(profiles.grams, top), len(profiles.grams) - 1)
    known = profiles.grams[at] == top
    ranks = profiles.ranks[:, at]
    distance = np.abs(ranks - np.arange(len(top)))
    distance = np.where(known & (ranks >= 0), np.minimum(distance, profiles.size), profiles.size)
    sums = distance.sum(axis=1)
    best = int(sums.argmin())
    return profiles.languages[best], 1.0 - float(sums[best]) / (profiles.size * len(top))
