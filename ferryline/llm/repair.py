"""Conversation structure repair by grammar-compressed dynamic programming.

A row of a conversation is one of nine symbols: the initial of its role and whether it is
truncated, or that it must go (blank, or said before). The cheapest edits that make the
roles read ``(s?(ua)+)?`` are a shortest path through four states, so a symbol is a 4 x 4
matrix of costs, and a sequence of symbols is their product in min-plus algebra. With each
cost goes a rope of the edits' initials; of equal costs the lesser text wins.

Sequences repeat within and between conversations. Re-Pair replaces the most frequent
pairs of neighbouring symbols by new symbols, in rounds over all different sequences; each
new symbol is a rule of two others and has one matrix, made bottom-up from theirs. What is
left of a sequence is multiplied in halves. A long conversation is cut into segments that
are solved apart, as products may be grouped at will.

From one state, edits of one cost never are a prefix of others of that cost (all that may
follow the last row are insertions, which cost more), and a text of edits leads to one
state. So the least text of a whole is made of the least texts of its parts.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.llm.common import staged

SPACES = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# Rows of a segment. Re-Pair makes at most RULES rules a round.
SEGMENT, ROUNDS, RULES = 4096, 6, 16
# Rows of one turn are ordered by role, then this many characters of the text, then its digest.
ORDER_CHARS = 64


class Repair(NamedTuple):
    """``conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``rows``: conv_id, segment, pos, sub (these three give the order), edit, role, text:
    the kept, rerolled and inserted rows.
    """

    conversations: DataFrame
    rows: DataFrame


def repair(
    df: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    segment_rows: int = SEGMENT,
) -> Repair:
    """Faults of conversations, and the cheapest edits that give them a regular form.

    Rows are taken in order of turn (nulls first), then role, then text. A row's first fault
    counts: blank (no character but white space), duplicate (role and text came earlier),
    truncated (its last such character is none of ``.!?``). ``gaps`` counts the turns that
    are missing between the least and the largest; ``illegal`` the neighbouring rows whose
    role initials are not su, ua or au. Edits: keep 0; rerole to user or assistant 1; delete
    2, the only edit of blank and duplicate rows; insert an empty row 5; a truncated row that
    is not deleted adds 5. ``audit`` holds their initials (K, R, D, I) in order.

    Null roles and texts are one space, and a role without characters is like one that is
    none of the three. Rows without an id are one conversation, with a null conv_id.
    Repeated rows are duplicates. An empty table gives no rows; other columns are not read.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )
    said = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    counted = rows.withColumn("said", said).groupBy("conv_id", "turn", "role", "text", "said")
    counted = staged(counted.agg(F.count("*").alias("copies")), "turns")
    placed = staged(_placed(_faults(counted), segment_rows), "placed")
    segments = staged(_segments(placed), "segments")
    edits = staged(_edits(segments), "edits")
    audits = edits.where("audit is not null").select("conv_id", "cost", "audit")
    known = _counts(placed, segments, counted).alias("k").join(
        audits.alias("a"), F.col("k.conv_id").eqNullSafe(F.col("a.conv_id"))
    )
    conversations = known.select("k.*", "cost", "audit")
    return Repair(conversations, _repaired(placed, edits))


def damaged(df: DataFrame) -> DataFrame:
    """Rows with faults set by a check sum of ``conv_id:turn``: conv_id, turn, role, text.

    Of twenty: 0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the
    row, 4 makes its role user. Nulls (of the check sum's parts too) are one space.
    """
    space = F.lit(" ")
    key = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    way = F.crc32(F.concat(key[0], F.lit(":"), key[1])) % 20
    return df.where(way != 0).select(
        "conv_id",
        "turn",
        F.when(way == 4, "user").otherwise(role).alias("role"),
        F.when(way == 1, "").when(way == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(way == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


# Faults and places


def _faults(counted: DataFrame) -> DataFrame:
    """One row for each row of the input, with its first fault: b, d, t or c (clean)."""
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = counted.groupBy("conv_id", "said").agg(F.min(turn).alias("first"))
    f, c = first.alias("f"), counted.alias("c")
    same = F.col("c.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("c.said") == F.col("f.said"))
    is_first = F.col("c.turn").eqNullSafe(F.col("f.first.turn"))
    joined = c.join(f, same).select("c.*", is_first.alias("is_first"))
    copies = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    ending = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    fault = (
        F.when(ending == "", "b")
        .when(~F.col("is_first") | (F.col("copy") > 1), "d")
        .when(~ending.isin(".", "!", "?"), "t")
        .otherwise("c")
    )
    return copies.select("conv_id", "turn", "role", "text", "said", "copy", fault.alias("fault"))


def _symbol() -> Column:
    """D for a row that must go, else the role's initial; upper case if truncated."""
    role = F.substring("role", 1, 1)
    role = F.when(role.isin("s", "u", "a"), role).otherwise("x")
    return (
        F.when(F.col("fault").isin("b", "d"), "D").when(F.col("fault") == "t", F.upper(role)).otherwise(role)
    )


def _placed(rows: DataFrame, segment_rows: int) -> DataFrame:
    """Rows with their segment and place in it; segments ascend in the order of rows.

    A conversation, or turn, with a large part of all rows fills several partitions.
    """
    order = [
        F.col("conv_id").asc_nulls_first(),
        F.col("turn").asc_nulls_first(),
        F.col("role"),
        F.substring("text", 1, ORDER_CHARS),
        F.col("said"),
        F.col("copy"),
    ]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select("conv_id", "role", "text", "fault", _symbol().alias("symbol"))
    schema = "conv_id long, role string, text string, fault string, symbol string, segment long, pos int"
    return ordered.mapInArrow(lambda batches: _places(batches, segment_rows), schema)


def _places(batches: Iterator[pa.RecordBatch], segment_rows: int) -> Iterator[pa.RecordBatch]:
    segment = TaskContext.get().partitionId() << 36
    last, pos = (), 0  # no conversation yet
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids = batch["conv_id"].fill_null(0).to_numpy()
        null = batch["conv_id"].is_null().to_numpy(zero_copy_only=False)
        new = np.ones(n, bool)
        new[1:] = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
        new[0] = last != (ids[0], null[0])
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(new, at, -1))
        place = np.where(start < 0, at + pos, at - start)
        cut = new | ((place % segment_rows == 0) & (place > 0))
        number = segment + np.cumsum(cut)
        segment, last, pos = int(number[-1]), (ids[-1], null[-1]), int(place[-1]) + 1
        columns = [*batch.columns, pa.array(number), pa.array((place % segment_rows).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "segment", "pos"])


def _segments(placed: DataFrame) -> DataFrame:
    """Each segment with its symbols, its role initials and the illegal pairs inside."""
    row = F.struct("pos", "symbol", F.substring("role", 1, 1).alias("initial"))
    found = placed.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    met = _neighbours("rows", lambda a, b: F.concat(a["initial"], b["initial"]))
    return found.select(
        "conv_id",
        "segment",
        F.array_join(F.transform("rows", lambda r: r["symbol"]), "").alias("symbols"),
        _illegal(met).alias("illegal"),
        F.element_at("rows", 1)["initial"].alias("first"),
        F.element_at("rows", -1)["initial"].alias("last"),
    )


def _neighbours(rows: str, pair: Callable) -> Column:
    """Something of each two neighbours of an array."""
    less = F.size(rows) - 1
    return F.zip_with(F.slice(rows, F.lit(1), less), F.slice(rows, F.lit(2), less), pair)


def _illegal(pairs: Column) -> Column:
    return F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))


def _counts(placed: DataFrame, segments: DataFrame, counted: DataFrame) -> DataFrame:
    def times(fault: str) -> Column:
        return F.count(F.when(F.col("fault") == fault, 1)).alias(
            {"b": "blank", "d": "duplicate", "t": "truncated"}[fault]
        )

    faults = placed.groupBy("conv_id").agg(times("b"), times("d"), times("t"))
    turns = counted.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id")
    turns = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    # Pairs at the borders of segments: few, as most conversations are one segment.
    order = F.struct("segment", "first", "last")
    inside = segments.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.array_sort(F.collect_list(order)).alias("ends")
    )
    met = _neighbours("ends", lambda a, b: F.concat(a["last"], b["first"]))
    inside = inside.select("conv_id", (F.col("illegal") + _illegal(met)).alias("illegal"))
    f, t, s = faults.alias("f"), turns.alias("t"), inside.alias("s")
    joined = f.join(t, F.col("f.conv_id").eqNullSafe(F.col("t.conv_id"))).join(
        s, F.col("f.conv_id").eqNullSafe(F.col("s.conv_id"))
    )
    return joined.select(
        "f.conv_id", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
        F.col("illegal").cast("long").alias("illegal"),
    )


# Min-plus matrices with ropes: a matrix has 16 entries (cost, rope), None where no edits lead.
# States: 0 nothing yet, 1 after a system row, 2 after a user row, 3 after an assistant row.

Rope = str | tuple
Entry = tuple[int, Rope] | None
Matrix = list[Entry]
ALPHABET = "suaxSUAXD"
_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}


def leaves(rope: Rope) -> Iterator[str]:
    """The texts of a rope, from left to right."""
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            yield top
        else:
            stack += (top[1], top[0])


def _less(a: Rope, b: Rope) -> bool:
    """Whether the text of one rope comes before that of another, which is no prefix of it."""
    left, right = (c for t in leaves(a) for c in t), (c for t in leaves(b) for c in t)
    for x, y in zip(left, right):
        if x != y:
            return x < y
    return next(left, None) is None and next(right, None) is not None


def _lesser(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if _less(b[1], a[1]) else a


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = []
    for i in range(4):
        for j in range(4):
            best: Entry = None
            for k in range(4):
                x, y = a[4 * i + k], b[4 * k + j]
                if x and y and (best is None or x[0] + y[0] <= best[0]):
                    best = _lesser(best, (x[0] + y[0], (x[1], y[1])))
            out.append(best)
    return out


def insertions() -> Matrix:
    """No or some insertions; more than two lead nowhere that fewer do not."""
    out: Matrix = [None] * 16
    for i in range(4):
        out[5 * i] = (0, "")
        state = i
        for n in (1, 2):
            state = _NEXT[state]
            out[4 * i + state] = _lesser(out[4 * i + state], (n * INSERT, "I" * n))
    return out


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions before a row, then an edit of it."""
    out: Matrix = [None] * 16
    for i in range(4):
        out[5 * i] = (DELETE, "D")
    if symbol != "D":
        more = TRUNCATED if symbol.isupper() else 0
        role = symbol.lower()
        kept = {"s": [(0, 1)], "u": [(0, 2), (1, 2), (3, 2)], "a": [(2, 3)], "x": []}[role]
        edits = [(i, j, KEEP, "K") for i, j in kept] + [(i, j, REROLE, "R") for i, j in _NEXT.items()]
        for i, j, cost, initial in edits:
            out[4 * i + j] = _lesser(out[4 * i + j], (cost + more, initial))
    return product(insertions(), out)


class Grammar:
    """Rules of a Re-Pair grammar, in the order made: new symbol and the pair it stands for."""

    def __init__(self, rules: list[tuple[str, str]] | None = None):
        self.rules = rules or []

    def compressed(self, text: str) -> str:
        for name, pair in self.rules:
            text = text.replace(pair, name)
        return text

    def matrices(self) -> dict[str, Matrix]:
        """The matrix of each symbol; a rule's from those of its two symbols."""
        made = {s: symbol_matrix(s) for s in ALPHABET}
        for name, (a, b) in self.rules:
            made[name] = product(made[a], made[b])
        return made


def pair_counts(texts: Iterator[str]) -> Counter:
    counts: Counter = Counter()
    for text in texts:
        counts.update(map("".join, zip(text, text[1:])))
    return counts


def evaluate(symbols: str, matrices: dict[str, Matrix]) -> Matrix:
    """The product of the matrices of some symbols, in halves."""
    if len(symbols) == 1:
        return matrices[symbols]
    half = len(symbols) // 2
    return product(evaluate(symbols[:half], matrices), evaluate(symbols[half:], matrices))


# On Spark


def learn(texts: DataFrame) -> Grammar:
    """Re-Pair over all texts of a frame (column symbols), a few rounds of several rules.

    The rules of a round share no symbol, so none of them changes the count of another. The
    driver sees the most frequent pairs only. Fewer rules would give the same results.
    """
    grammar = Grammar()
    for _ in range(ROUNDS):
        pairs = texts.select("symbols").mapInArrow(_pairs(grammar), "pair string, n long")
        top = pairs.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        top = top.orderBy(F.desc("n"), "pair").limit(4 * RULES).collect()
        used: set[str] = set()
        fresh = []
        for pair, _n in top:
            if len(fresh) < RULES and not used & set(pair):
                used |= set(pair)
                fresh.append(pair)
        if not fresh:
            break
        grammar.rules += [(chr(0x100 + len(grammar.rules) + i), p) for i, p in enumerate(fresh)]
    return grammar


def _pairs(grammar: Grammar) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts += pair_counts(grammar.compressed(t) for t in batch["symbols"].to_pylist())
        names, n = list(counts), list(counts.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(n, pa.int64())], ["pair", "n"]
        )

    return run


def _edits(segments: DataFrame) -> DataFrame:
    """Edits in order: conv_id, segment, pos, sub, edit, role, with cost and audit on the last.

    Each different sequence of symbols is solved once.
    """
    different = staged(segments.select("symbols").distinct(), "symbols")
    grammar = learn(different)
    solved = different.mapInArrow(
        _solve(grammar), "symbols string, costs array<int>, audits array<string>"
    )
    joined = segments.select("conv_id", "segment", "symbols").join(staged(solved, "solved"), "symbols")
    ordered = joined.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return ordered.mapInArrow(
        _resolve,
        "conv_id long, segment long, pos int, sub int, edit string, role string, cost long, audit string",
    )


def _solve(grammar: Grammar) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = grammar.matrices()
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                texts = batch["symbols"].slice(start, 200)
                made = [evaluate(grammar.compressed(t), matrices) for t in texts.to_pylist()]
                costs = [[e and e[0] for e in m] for m in made]
                audits = [[e and "".join(leaves(e[1])) for e in m] for m in made]
                yield pa.RecordBatch.from_arrays(
                    [
                        texts,
                        pa.array(costs, pa.list_(pa.int32())),
                        pa.array(audits, pa.list_(pa.string())),
                    ],
                    ["symbols", "costs", "audits"],
                )

    return run


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Segments of each conversation: (conv_id, segment, symbols, matrix)."""
    held: list[tuple] = []
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("conv_id", "segment", "symbols", "costs", "audits")]
        for key, segment, symbols, costs, audits in zip(*columns):
            if held and held[0][0] != key:
                yield held
                held = []
            matrix = [None if c is None else (c, a) for c, a in zip(costs, audits)]
            held.append((key, segment, symbols, matrix))
    if held:
        yield held


def best_path(matrices: list[Matrix]) -> tuple[int, list[str]]:
    """The least cost over some segments, and the edits of each."""
    entries: list[Entry] = [(0, ("", "")), None, None, None]
    for matrix in matrices:
        # Ropes grow to the left, one text for each segment.
        following: list[Entry] = []
        for j in range(4):
            best: Entry = None
            for i in range(4):
                x, y = entries[i], matrix[4 * i + j]
                if x and y:
                    best = _lesser(best, (x[0] + y[0], (x[1], y[1])))
            following.append(best)
        entries = following
    end = insertions()
    best = None
    for i in range(4):
        for j in (0, 3):
            x, y = entries[i], end[4 * i + j]
            if x and y:
                best = _lesser(best, (x[0] + y[0], (x[1], y[1])))
    cost, rope = best
    parts = []
    while len(parts) <= len(matrices):
        rope, part = rope
        parts.append("".join(leaves(part)))
    parts.reverse()
    return cost, [*parts[:-2], parts[-2] + parts[-1]]


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("segment", pa.int64()),
            ("pos", pa.int32()),
            ("sub", pa.int32()),
            ("edit", pa.string()),
            ("role", pa.string()),
            ("cost", pa.int64()),
            ("audit", pa.string()),
        ]
    )
    out: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*out), schema.types)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for segments in _conversations(batches):
        cost, parts = best_path([m for *_, m in segments])
        state = 0
        for (key, segment, symbols, _), part in zip(segments, parts):
            pos = sub = 0
            for edit in part:
                role = None
                if edit in "IR":
                    state = _NEXT[state]
                    role = {2: "user", 3: "assistant"}[state]
                elif edit == "K":
                    state = {"s": 1, "u": 2, "a": 3}[symbols[pos].lower()]
                out.append((key, segment, pos, sub, edit, role, None, None))
                sub += 1
                if edit != "I":
                    pos, sub = pos + 1, 0
                if len(out) >= 20_000:
                    yield made()
                    out.clear()
        out.append((key, segments[-1][1], len(segments[-1][2]), 99, None, None, cost, "".join(parts)))
    if out:
        yield made()


def _repaired(placed: DataFrame, edits: DataFrame) -> DataFrame:
    e = edits.where("edit in ('K', 'R')").alias("e")
    p = placed.alias("p")
    same = (F.col("e.segment") == F.col("p.segment")) & (F.col("e.pos") == F.col("p.pos"))
    stay = e.join(p, same).select(
        "e.conv_id", "e.segment", "e.pos", "e.sub", "e.edit",
        F.coalesce("e.role", "p.role").alias("role"), "p.text",
    )
    added = edits.where("edit = 'I'").select(
        "conv_id", "segment", "pos", "sub", "edit", "role", F.lit("").alias("text")
    )
    return stay.unionByName(added)


def digests(rows: DataFrame) -> DataFrame:
    """The digest of each conversation's ``role:text`` rows, joined by newlines.

    A digest is made row by row in order, so one conversation is one pass of one task, which
    holds one row at a time.
    """
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "pos", "sub")
    return ordered.select("conv_id", "role", "text").mapInArrow(_digest, "conv_id long, repaired_sha256 string")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest = None, None
    for batch in batches:
        keys, found = [], []
        for conv_id, role, text in zip(*[batch[c].to_pylist() for c in ("conv_id", "role", "text")]):
            if digest is not None and conv_id == key:
                digest.update(b"\n")
            else:
                if digest is not None:
                    keys.append(key)
                    found.append(digest.hexdigest())
                key, digest = conv_id, hashlib.sha256()
            digest.update(f"{role}:{text}".encode())
        yield _digest_batch(keys, found)
    if digest is not None:
        yield _digest_batch([key], [digest.hexdigest()])


def _digest_batch(keys: list, found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"]
    )
