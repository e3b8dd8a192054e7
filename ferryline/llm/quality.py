"""Quality classifier: a generalised additive model with pairwise interactions.

The log odds of a good text are a sum of tables: one for each feature, by the bin that the
feature's value falls into, and one for each chosen pair of features, by two coarser bins.
The tables are learned by cyclic boosting: in turn, each feature gets a small step along the
best tree with two levels of cuts over its bins, fitted to what the sum still gets wrong;
then, with the single tables fixed, the same is done for the pairs in which cuts on both
features gain most. Scoring is one look-up and addition for each table, for many texts at
once. All features are counts and shares over the whole text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.common import filled, slices

# A fit uses at most this many labels, those with the smallest hash of id and label.
SAMPLE = 20_000
BINS, COARSE = 32, 8
ROUNDS, PAIRS, PAIR_ROUNDS = 200, 8, 100
RATE, RIDGE, LEAST_WEIGHT = 0.1, 1.0, 1.0

FEATURES = (
    "log_chars",
    "log_words",
    "mean_word",
    "log_longest_word",
    "letters",
    "capitals",
    "digits",
    "spaces",
    "stops",
    "marks",
    "symbols",
    "byte_entropy",
    "lines_a_word",
    "repeated_lines",
    "different_words",
    "commonest_word",
    "different_pairs",
)


# Features

_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _MARK, _SYMBOL, _BEYOND = range(8)
_CLASS = np.full(256, _SYMBOL, np.uint8)
_CLASS[[*b"abcdefghijklmnopqrstuvwxyz"]] = _LOWER
_CLASS[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = _UPPER
_CLASS[[*b"0123456789"]] = _DIGIT
_CLASS[[*b" \t\n\x0b\f\r"]] = _SPACE
_CLASS[[*b".,;:"]] = _STOP
_CLASS[[*b"!?'\"()-"]] = _MARK
_CLASS[128:] = _BEYOND


def measures(text: str) -> list[float]:
    """The features of a text, in the order of FEATURES; shares of nothing are 0."""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(1, len(raw))
    of = np.bincount(_CLASS, counts, 8)
    words = raw.split()
    n_words = max(1, len(words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    shares = counts[counts > 0] / n
    letters = of[_LOWER] + of[_UPPER] + of[_BEYOND]
    often = Counter(words)
    pairs = len(words) - 1
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        sum(map(len, words)) / n_words,
        math.log1p(max(map(len, words), default=0)),
        letters / n,
        of[_UPPER] / max(1.0, of[_LOWER] + of[_UPPER]),
        of[_DIGIT] / n,
        of[_SPACE] / n,
        of[_STOP] / n,
        of[_MARK] / n,
        of[_SYMBOL] / n,
        float(-(shares * np.log2(shares)).sum()),
        len(lines) / n_words,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        len(often) / n_words,
        max(often.values(), default=0) / n_words,
        len(set(zip(words, words[1:]))) / pairs if pairs > 0 else 0.0,
    ]


# The model


@dataclass
class Model:
    """Edges of bins for each feature, the tables, and the log odds they are added to."""

    edges: list[np.ndarray]
    intercept: float = 0.0
    singles: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, values: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, v, "right") for e, v in zip(self.edges, values.T)], 1)

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Chances of a good text, for rows of features."""
        bins = self.bins(values)
        total = np.full(len(values), self.intercept)
        for f, single in enumerate(self.singles):
            total += single[bins[:, f]]
        for a, b, both in self.pairs:
            total += both[coarse(bins[:, a]), coarse(bins[:, b])]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def coarse(bins: np.ndarray) -> np.ndarray:
    return bins // (BINS // COARSE)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.where(h >= LEAST_WEIGHT, g * g / (h + RIDGE), -np.inf)


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The gain of the best cut of a row of bins and the first bin after it; 0 if none helps."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gain = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h)
    gain = gain - all_g * all_g / (all_h + RIDGE)
    at = int(gain.argmax())
    return (float(gain[at]), at + 1) if gain[at] > 1e-12 else (0.0, 0)


def tree_step(g: np.ndarray, h: np.ndarray, levels: int = 2) -> np.ndarray:
    """The step of a tree with some levels of cuts over a row of bins."""
    cut = best_cut(g, h)[1] if levels else 0
    if not cut:
        return np.full(len(g), RATE * g.sum() / (h.sum() + RIDGE))
    parts = (slice(0, cut), slice(cut, None))
    return np.concatenate([tree_step(g[p], h[p], levels - 1) for p in parts])


def pair_step(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The gain and the step of the best tree that cuts rows, and each side's columns."""
    best, chosen = -1.0, (0, 0, 0)
    top_g, top_h = np.cumsum(g, axis=0), np.cumsum(h, axis=0)
    whole = g.sum() ** 2 / (h.sum() + RIDGE)
    for cut in range(1, len(g)):
        sides = (
            (top_g[cut - 1], top_h[cut - 1]),
            (top_g[-1] - top_g[cut - 1], top_h[-1] - top_h[cut - 1]),
        )
        found = [best_cut(*s) for s in sides]
        gain = sum(f[0] + s[0].sum() ** 2 / (s[1].sum() + RIDGE) for f, s in zip(found, sides)) - whole
        if all(f[1] for f in found) and gain > best:
            best, chosen = gain, (cut, found[0][1], found[1][1])
    step = np.zeros_like(g)
    cut, left, right = chosen
    if cut:
        for rows, at in ((slice(0, cut), left), (slice(cut, None), right)):
            for columns in (slice(0, at), slice(at, None)):
                step[rows, columns] = RATE * g[rows, columns].sum() / (h[rows, columns].sum() + RIDGE)
    return best, step


def fit(values: np.ndarray, label: np.ndarray) -> Model:
    """Learn the tables from rows of features and labels 0 and 1.

    Without rows the chance is one half everywhere; with one label only it is that label's
    share, with half a row added for either.
    """
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(v, quantiles)) if len(v) else np.zeros(0) for v in values.T]
    good = float(label.sum())
    model = Model(edges, math.log((good + 0.5) / (len(label) - good + 0.5)))
    model.singles = [np.zeros(BINS) for _ in edges]
    if not 0 < good < len(label):
        return model
    bins = model.bins(values)
    total = np.full(len(label), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        chance = 1 / (1 + np.exp(-total))
        return label - chance, chance * (1 - chance)

    for _ in range(ROUNDS):
        for f, single in enumerate(model.singles):
            g, h = slopes()
            of = bins[:, f]
            step = tree_step(np.bincount(of, g, BINS), np.bincount(of, h, BINS))
            single += step
            total += step[of]
    rough = coarse(bins)
    cells = {
        (a, b): rough[:, a] * COARSE + rough[:, b] for a, b in combinations(range(len(edges)), 2)
    }

    def step_of(pair: tuple[int, int], g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        shape, of = (COARSE, COARSE), cells[pair]
        return pair_step(
            np.bincount(of, g, COARSE**2).reshape(shape), np.bincount(of, h, COARSE**2).reshape(shape)
        )

    g, h = slopes()
    gains = sorted(((step_of(p, g, h)[0], p) for p in cells), key=lambda x: (-x[0], x[1]))
    tables = {p: np.zeros((COARSE, COARSE)) for gain, p in gains[:PAIRS] if gain > 0}
    for _ in range(PAIR_ROUNDS):
        for pair, both in tables.items():
            step = step_of(pair, *slopes())[1]
            both += step
            total += step.ravel()[cells[pair]]
    model.pairs = [(a, b, both) for (a, b), both in tables.items()]
    return model


# On Spark


def learn(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "label",
    sample: int = SAMPLE,
) -> Model:
    """Fit a model to the texts of documents that a label (0 or 1; others are left out) exists for.

    At most ``sample`` labels are used, those with the smallest hash of id and label, so that
    the choice does not depend on how rows are stored. It is made before texts are read: the
    labels chosen are broadcast, and texts are not shuffled. The driver gets features only,
    again of ``sample`` rows at most if documents repeat. Null texts are empty, repeated rows
    count as often as they occur, and rows without an id teach nothing.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
    known = known.where("id is not null and label in (0, 1)").withColumn("place", F.xxhash64("id", "label"))
    n = known.count()
    if n > sample:
        # So few lie below this place that choosing among them is cheap.
        known = known.where(F.col("place") <= int(-(2**63) + 2**64 * (sample / n)))
    chosen = known.orderBy("place", "id").limit(sample)
    rows = documents.select(F.col(id_col).alias("id"), filled(text_col).alias("text"))
    taught = rows.join(F.broadcast(chosen), "id").select("text", "place", "label")
    measured = taught.mapInArrow(_measure, "place long, label double, features array<double>")
    found = measured.orderBy("place", "features").limit(sample).select("label", "features").toPandas()
    values = np.array(found["features"].tolist(), float).reshape(len(found), len(FEATURES))
    return fit(values, found["label"].to_numpy(float))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row with its chance of a good text: doc_id, score (0 to 1), predicted (1 from 0.5 on).

    Null texts count as empty, and these are scored like others. Rows without an id and
    repeated rows are rows like any other. An empty table gives no rows; other columns are
    not read.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), filled(text_col).alias("text"))
    return rows.mapInArrow(_score(model), "doc_id long, score double, predicted int")


def _values(texts: pa.Array) -> np.ndarray:
    found = [measures(t.as_py()) for t in texts]
    return np.array(found, float).reshape(len(found), len(FEATURES))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = pa.array(_values(batch["text"]).tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays(
            [batch["place"], batch["label"], found], ["place", "label", "features"]
        )


def _score(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            chance = model.scores(_values(batch["text"]))
            predicted = (chance >= 0.5).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(chance), pa.array(predicted)],
                ["doc_id", "score", "predicted"],
            )

    return run
