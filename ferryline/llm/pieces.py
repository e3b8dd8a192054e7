"""SentencePiece encoding and decoding by a weighted transducer.

The model file is compiled into three parts: the normaliser (spaces become the space
mark, with one put in front), a trie of the pieces, and byte fallback for characters
without a piece. Composed with an input they give a lattice whose paths are the ways to
spell it. The weight of a piece depends on the piece before it, in the tropical semiring:
zero if the model's merges, run on the two together, leave that very boundary, infinite
otherwise. A spelling by merges is one whose neighbours all stay apart, so the path of
finite weight is the shortest one, and it is found depth first, longest pieces first.

Two characters that stand side by side in no piece are a border that no path crosses, so
the lattice falls into words at space marks and ends of lines, and words into their
letters and stops. Spellings of these parts are kept in a bounded store that lives as long
as its worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.common import filled, slices

MARK = "▁"
# Bounds of a worker's stores: words with and without a mark, and pairs of pieces.
KNOWN_WORDS, KNOWN_PAIRS = 300_000, 400_000
BPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and contents of a protocol buffer's fields."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


class Words(dict):
    """Spellings of words with something in front; emptied when full."""

    def __init__(self, owner: Transducer, front: str):
        super().__init__()
        self.owner, self.front = owner, front

    def __missing__(self, word: str) -> bytes:
        found = self.owner.spelling(self.front + word)
        if len(word) <= 64:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = found
        return found


class Transducer:
    """A compiled model file of merges (BPE)."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as file:
            parts = [f for f in _fields(file.read()) if f[0] in (2, 3)]
        # Field numbers are fixed by the file format.
        trainer = dict(_fields(next(v for n, v in parts if n == 2)))
        normal = dict(_fields(next((v for n, v in parts if n == 3), b"")))
        if trainer.get(3, 1) != BPE:
            raise ValueError("only models of merges are compiled")
        if normal.get(2) or not normal.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only plain normalisers are compiled")
        self.prefix, self.trim = bool(normal.get(3, 1)), bool(normal.get(4, 1))
        model = SentencePieceProcessor(model_file=path)
        self.unknown = model.unk_id()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.spelt: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            spelt = piece.replace(MARK, " ").encode()
            if model.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
                spelt = bytes([int(piece[3:-1], 16)])
            elif model.is_control(i):
                spelt = b""
            elif model.is_unknown(i):
                spelt = " ⁇ ".encode()
            elif not model.is_unused(i):
                self.ids[piece] = i
                self.scores[piece] = model.get_score(i)
            self.spelt.append(spelt)
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a space mark after another character")
        # Of each character: the characters that follow, and the piece that ends here.
        self.trie: dict[str, tuple] = {}
        for piece in self.ids:
            node = self.trie
            for c in piece[:-1]:
                node = node.setdefault(c, ({}, None))[0]
            below = node[piece[-1]][0] if piece[-1] in node else {}
            node[piece[-1]] = (below, piece)
        self.side_by_side = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.by_line = not any("\n" in p for p in self.ids)
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        self.inner, self.first = Words(self, MARK), Words(self, "")

    def merged(self, text: str) -> list[str]:
        """What the merges make of a text: best score first, the leftmost if equal."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def apart(self, left: str, right: str) -> bool:
        """Whether the weight of ``right`` after ``left`` is zero."""
        if self.n_pairs >= KNOWN_PAIRS:
            self.pairs.clear()
            self.n_pairs = 0
        known = self.merged(left + right) == [left, right]
        self.pairs.setdefault(left, {})[right] = known
        self.n_pairs += 1
        return known

    def arcs(self, text: str, at: int) -> list[str]:
        """Pieces that the text goes on with, longest last, or a character without one."""
        node, found = self.trie, []
        for c in text[at:]:
            step = node.get(c)
            if step is None:
                break
            node, piece = step
            if piece is not None:
                found.append(piece)
        if not found or len(found[0]) > 1:
            found.insert(0, text[at])
        return found

    def shortest(self, text: str) -> list[str]:
        """The path of least weight through the lattice of a normalised text."""
        path: list[str] = []
        others: list[list[str]] = []  # arcs not tried at each step
        dead: set[tuple[int, str]] = set()
        at, n = 0, len(text)
        while at < n:
            open_arcs = self.arcs(text, at)
            while True:
                known = self.pairs.get(path[-1], {}) if path else None
                arc = None
                while open_arcs:
                    arc = open_arcs.pop()
                    if known is None:
                        free = True
                    elif (free := known.get(arc)) is None:
                        free = self.apart(path[-1], arc)
                    if free and not (dead and (at, arc) in dead):
                        break
                    arc = None
                if arc is not None:
                    break
                if not path:
                    raise ValueError("a text has no path of finite weight")
                back = path.pop()
                at -= len(back)
                dead.add((at, back))
                open_arcs = others.pop()
            path.append(arc)
            others.append(open_arcs)
            at += len(arc)
        return path

    def _spelt(self, text: str) -> bytes:
        ids: list[int] = []
        for arc in self.shortest(text):
            known = self.ids.get(arc)
            if known is not None:
                ids.append(known)
            elif self.bytes:
                ids += [self.bytes[b] for b in arc.encode()]
            else:
                ids.append(self.unknown)
        return np.asarray(ids, "<i4").tobytes()

    def spelling(self, text: str) -> bytes:
        """Ids of a normalised text, cut at each border that no piece crosses."""
        cuts = [
            i
            for i in range(1, len(text))
            if text[i - 1 : i + 1] not in self.side_by_side and text[i] != MARK
        ]
        if not cuts:
            return self._spelt(text)
        # A part has no border inside, so its own spelling cuts no further.
        parts = zip([0, *cuts], [*cuts, len(text)])
        return b"".join([self.first[text[a:b]] for a, b in parts])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        if MARK in text:
            text = text.replace(MARK, " ")
        if self.trim:
            text = " ".join(filter(None, text.split(" ")))
        if not text:
            return b""
        if self.prefix:
            text = " " + text
        if not self.by_line:
            return self._line(text)
        return self.first["\n"].join(map(self._line, text.split("\n")))

    def _line(self, text: str) -> bytes:
        first, *words = text.split(" ")
        if "" not in words:
            inner = list(map(self.inner.__getitem__, words))
            return b"".join([self.first[first], *inner]) if first else b"".join(inner)
        # Several spaces in a row, or one at the end.
        out, marks = [self.first[first]] if first else [], 0
        for word in words:
            marks += 1
            if word:
                out.append(self.first[MARK * marks + word])
                marks = 0
        if marks:
            out.append(self.first[MARK * marks])
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are not UTF-8 become the replacement character."""
        spelt = self.spelt
        text = b"".join([spelt[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


@cache
def transducer(path: str) -> Transducer:
    return Transducer(path)


def encode(
    df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Texts as ids: doc_id, ids, n_tokens.

    One row for each row given, repeated ones too. Null and empty texts get no ids, a null
    id stays null, an empty table gives no rows. Other columns are not read.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), filled(text_col).alias("text"))
    return rows.mapInArrow(_encode(model), "doc_id long, ids array<int>, n_tokens long")


def decode(df: DataFrame, model: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """Add the text of ids as ``out_col``, in place of a column of that name.

    Null ids give null, no ids the empty text; an unknown id is an error.
    """
    kept = [c for c in df.columns if c != out_col]
    names = [f"c{i}" for i in range(len(kept))]
    given = df.select(*kept).toDF(*names)
    schema = df.select(*kept).toDF(*names).schema.add("text", "string")
    at = kept.index(ids_col)
    return given.mapInArrow(_decode(model, at), schema).toDF(*kept, out_col)


def _encode(model: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = transducer(model).encode
        for batch in slices(batches):
            spelt = [code(text.as_py()) for text in batch["text"]]
            sizes = np.array([len(s) // 4 for s in spelt], np.int64)
            stops = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            ids = pa.array(np.frombuffer(b"".join(spelt), "<i4"))
            columns = [batch["doc_id"], pa.ListArray.from_arrays(stops, ids), pa.array(sizes)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_tokens"])

    return run


def _decode(model: str, at: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = transducer(model).decode
        for batch in slices(batches):
            found = [
                None if ids is None else text(np.asarray(ids.values).tolist())
                for ids in (x if x.is_valid else None for x in batch.column(at))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "text"]
            )

    return run
