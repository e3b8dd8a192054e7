"""N-gram Jaccard join by chosen paths.

Each text is the set of its shingles of words. A run is a random tree: a node passes a set
on to a child for each of its shingles that the node samples and the path has not taken, with
a chance of one in (threshold * size of the set - shingles taken), so two similar sets expect
to share at least one child at every depth, however small they are. Sets
that meet in a small node are compared there; a larger node is split by its children, down
to DEPTH. One run finds a similar pair with a known chance, so runs are repeated until the
target recall is reached: their number follows from the threshold, the depth and the target.

Sets that meet in a small node are compared on short sketches first. Those that may be
similar form groups, as do all sets of a node that is large at full depth, similar or not.
In each group every pair of different sets is compared exactly, in blocks. So no pair is
written out: what leaves a block is each set's number of links, and a few edges that hold
its part of the group together.

Equal sets are one set with a weight, so copies cost nothing from the first step on.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.common import filled, slices, staged
from ferryline.llm.components import components

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.995
DEPTH = 3
# A node with more sets is split, down to DEPTH.
SMALL = 48
# Sets of one side of a block of comparisons.
BLOCK = 256
SKETCH = 64
# A similar pair agrees on fewer places of its sketch once in some 30,000 cases.
_MARGIN = 4.0

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S = np.uint64(29)

SETS = (
    "row long, doc_id long, text_hash long, key binary, size int, sketch binary, "
    "paths array<struct<h1:long,h2:long,h3:long>>"
)


def runs_needed(recall: float, depth: int = DEPTH) -> int:
    """Runs that find a pair right at the threshold with at least the given chance.

    Such a pair has m shingles in common that its path has not taken, and each is sampled
    with a chance of 1 / m at least. So it meets at a depth with chance 1 - (1 - c / m) ** m,
    where c is the chance below. That is least for large sets, where it is 1 - exp(-c). More
    similar pairs meet more often, and most nodes are small before the full depth.
    """
    chance = 1.0
    for _ in range(depth):
        chance = 1.0 - math.exp(-chance)
    return math.ceil(math.log(1.0 - recall) / math.log(1.0 - chance))


def join(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
    recall: float = RECALL,
) -> DataFrame:
    """Each row with its group of near duplicates: doc_id, class_id, links, kept, text_hash.

    Words are lower-cased and divided by ASCII white space. A text with fewer words than a
    shingle has one shingle of them all. ``links`` is the number of other rows whose
    similarity is at least the threshold, copies included; groups are connected by links;
    ``class_id`` is the smallest id of the group, and one row with it is ``kept``, the first by
    text hash.
    Null texts and texts without words have no shingles: no links, a class of their own.
    A row without an id takes no part: no class, no links, kept. Repeated rows are copies, of
    which one is kept.
    ``text_hash`` (xxhash64 of the text) tells rows with one id apart. An empty table gives
    no rows.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), filled(text_col).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    n_runs = runs_needed(recall)
    sets = staged(rows.mapInArrow(_sets(words, threshold, n_runs), SETS), "sets")
    taking_part = sets.where("doc_id is not null and size > 0")
    classes = staged(
        taking_part.groupBy("key").agg(
            F.min("doc_id").alias("rep"),
            F.count("*").alias("weight"),
            F.first("size").alias("size"),
            F.first("sketch").alias("sketch"),
            F.first("paths").alias("paths"),
        ),
        "classes",
    )
    groups = components(_meetings(classes, threshold))
    checked = staged(_checked(rows, classes, groups, threshold, words), "checked")
    linked = checked.groupBy("key").agg(F.sum("links").alias("links"))
    edges = checked.where("other is not null").select(
        F.col("key").alias("a"), F.col("other").alias("b")
    )
    roots = components(edges)
    known = (
        classes.select("key", "rep", "weight")
        .join(linked, "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    least = known.groupBy("root").agg(F.min("rep").alias("class_id"))
    known = known.join(least, "root").select(
        "key", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links")
    )
    # Of the rows with a class's id one stays: the first by text hash, and of repeated rows any.
    first = sets.join(known.select("key", "root", "class_id"), "key").where("doc_id = class_id")
    first = first.groupBy("root").agg(F.min(F.struct("text_hash", "row"))["row"].alias("row"))
    out = sets.select("row", "doc_id", "text_hash", "key", "size").join(known, "key", "left")
    out = out.join(first.select("row", F.lit(True).alias("first")), "row", "left")
    part = F.col("doc_id").isNotNull() & (F.col("size") > 0)
    return out.select(
        "doc_id",
        F.when(part, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(part, F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("links"),
        "text_hash",
        (~part | F.coalesce("first", F.lit(False))).alias("kept"),
    )


def _meetings(classes: DataFrame, threshold: float) -> DataFrame:
    """Edges between sets that meet in a small node and may be similar by their sketches."""
    first = F.array_distinct(F.transform("paths", lambda p: p["h1"]))
    nodes = classes.select("key", F.explode(first).alias("h1"))
    paths = classes.select("key", F.explode("paths").alias("p")).select("key", "p.*")
    stopped, spent = [], []
    for level in range(1, DEPTH + 1):
        h = f"h{level}"
        # Written first: the join then has a plain shuffle on either side, so that Spark can
        # split a node that a large part of all sets is in.
        sizes = nodes.groupBy(h).agg(F.count("*").alias("n")).where("n > 1")
        met = staged(paths.join(staged(sizes, f"sizes{level}"), h), f"level{level}")
        ends = met if level == DEPTH else met.where(F.col("n") <= SMALL)
        small = F.col("n") <= SMALL
        stopped.append(ends.select(F.col(h).alias("node"), "key", small.alias("small")).distinct())
        if level < DEPTH and level / threshold >= level + 1:
            # A set whose shingles are all taken has no child; the node's sets contain it.
            inside = met.where(F.col("n") > SMALL).select(F.col(h).alias("node"), "key").distinct()
            inside = inside.join(classes.select("key", "size"), "key")
            whole = inside.where(F.col("size") == level).select("node", F.col("key").alias("b"))
            near = inside.where((F.col("size") > level) & (F.col("size") * threshold <= level + 1e-9))
            spent.append(near.join(whole, "node").select(F.col("key").alias("a"), "b"))
        if level < DEPTH:
            paths = met.where(F.col("n") > SMALL).drop("n")
            below = f"h{level + 1}"
            nodes = paths.where(F.col(below).isNotNull()).select("key", below).distinct()
    nodes = stopped[0]
    for more in stopped[1:]:
        nodes = nodes.unionByName(more)
    nodes = staged(nodes, "nodes")
    # All sets of a large node at full depth share several sampled shingles: one group.
    large = nodes.where("not small")
    least = large.groupBy("node").agg(F.min("key").alias("b"))
    tied = large.join(least, "node").select(F.col("key").alias("a"), "b")
    small = nodes.where("small").select("node", "key").join(
        classes.select("key", "size", "sketch"), "key"
    )
    ordered = small.repartition("node").sortWithinPartitions("node", "key")
    met = ordered.mapInArrow(_compare(threshold), "a binary, b binary")
    met = met.unionByName(tied)
    for more in spent:
        met = met.unionByName(more)
    return met


def _dealt(rows: DataFrame, group: str, block_rows: int, columns: list[str]) -> DataFrame:
    """Each pair of blocks of a group's rows (by key) as a tile; tiles spread evenly over tasks."""
    sizes = rows.groupBy(group).agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    placed = rows.join(sizes, group).withColumn("blocks", blocks)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = placed.select(
        group,
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "key",
        *columns,
    )
    # By ranges, not by hash: Spark samples where the rows are, so tiles do not pile up.
    order = [group, "i", "j"]
    return tiles.repartitionByRange(*order).sortWithinPartitions(*order, "key")


def _checked(
    rows: DataFrame, classes: DataFrame, groups: DataFrame, threshold: float, words: int
) -> DataFrame:
    """Exact comparison within groups: key, links found in a block, other set of an edge.

    A large group is cut into blocks, and each pair of blocks is a task of its own.
    """
    members = groups.select(F.col("node").alias("key"), "root")
    chosen = members.join(classes.select("key", "rep", "weight"), "key")
    # One text for each set; a row with the same id but another set is left out inside.
    texts = chosen.join(rows.select(F.col("doc_id").alias("rep"), "text"), "rep")
    shingled = staged(
        texts.select("key", "root", "weight", "text").mapInArrow(
            _shingled(words), "key binary, root binary, weight long, shingles binary"
        ).dropDuplicates(["key"]),
        "shingles",
    )
    dealt = _dealt(shingled, "root", BLOCK, ["weight", "shingles"])
    return dealt.mapInArrow(_tiles(threshold), "key binary, links long, other binary")


# Sets


def shingles(text: str, words: int) -> np.ndarray:
    """Different shingles of a text as sorted 64-bit numbers."""
    parts = text.lower().encode("utf-8", "surrogatepass").split()
    n = len(parts)
    if not n:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter([digest(p) for p in parts], np.uint64, n)
    size = min(n, words)
    out = np.full(n - size + 1, np.uint64(size))
    for i in range(size):
        out = (out ^ hashes[i : n - size + 1 + i]) * _M1
        out ^= out >> _S
    return np.unique(out)


def set_key(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _sampled(nodes: np.ndarray, found: np.ndarray, below: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Which shingles (second) which nodes (first) pass a set on for."""
    mixed = (nodes[:, None] ^ found[None]) * _M1
    mixed ^= mixed >> _S
    mixed *= _M2
    return np.nonzero(mixed <= below)


def _child(nodes: np.ndarray, found: np.ndarray) -> np.ndarray:
    mixed = (nodes * _M2) ^ found
    mixed ^= mixed >> _S
    return mixed * _M1


def paths(found: np.ndarray, threshold: float, n_runs: int) -> list[tuple]:
    """Chosen paths of a set: the nodes at each depth, None below the last one."""
    roots = np.arange(1, n_runs + 1, dtype=np.uint64) * _M2
    tops: list[tuple] = [()] * n_runs
    out, nodes, taken = [], roots, [()] * n_runs
    for depth in range(DEPTH):
        # Two similar sets share threshold * size or more, less the shingles taken.
        left = max(1.0, threshold * len(found) - depth)
        below = np.uint64(min(2**64 - 1, int(2**64 / left)))
        at, which = _sampled(nodes, found, below)
        if len(at):
            token = found[which]
            fresh = np.array([which[k] not in taken[a] for k, a in enumerate(at)], bool)
            at, which, token = at[fresh], which[fresh], token[fresh]
        has_child = np.zeros(len(nodes), bool)
        has_child[at] = True
        out += [tops[k] for k in np.flatnonzero(~has_child) if tops[k]]
        children = _child(nodes[at], found[which])
        tops = [tops[a] + (int(c),) for a, c in zip(at, children.view(np.int64))]
        taken = [taken[a] + (w,) for a, w in zip(at, which)]
        nodes = children
    return out + tops


def sketch(found: np.ndarray) -> bytes:
    """The lowest byte of the smallest of each of SKETCH hashes of a set."""
    least = np.full(SKETCH, np.uint64(2**64 - 1))
    for i in range(0, len(found), 4096):
        mixed = found[i : i + 4096, None] * _ODD
        mixed ^= mixed >> _S
        least = np.minimum(least, (mixed * _M2).min(axis=0))
    return (least >> np.uint64(24)).astype(np.uint8).tobytes()


_ODD = np.random.default_rng(5).integers(0, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sets(words: int, threshold: float, n_runs: int) -> Callable:
    path = pa.struct([("h1", pa.int64()), ("h2", pa.int64()), ("h3", pa.int64())])
    schema = pa.schema(
        [
            ("row", pa.int64()),
            ("doc_id", pa.int64()),
            ("text_hash", pa.int64()),
            ("key", pa.binary()),
            ("size", pa.int32()),
            ("sketch", pa.binary()),
            ("paths", pa.list_(path)),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in slices(batches):
            keys, sizes, sketches, stops, levels = [], [], [], [0], []
            for text in batch["text"]:
                found = shingles(text.as_py(), words)
                keys.append(set_key(found))
                sizes.append(len(found))
                sketches.append(sketch(found) if len(found) else b"")
                if len(found):
                    levels += [p + (None,) * (DEPTH - len(p)) for p in paths(found, threshold, n_runs)]
                stops.append(len(levels))
            columns = list(zip(*levels)) or [()] * DEPTH
            nested = pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], fields=list(path)
            )
            arrays = [
                pa.array(np.arange(row, row + batch.num_rows)),
                batch["doc_id"],
                batch["text_hash"],
                pa.array(keys, pa.binary()),
                pa.array(sizes, pa.int32()),
                pa.array(sketches, pa.binary()),
                pa.ListArray.from_arrays(pa.array(stops, pa.int32()), nested),
            ]
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def _shingled(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(text.as_py(), words) for text in batch["text"]]
            own = [set_key(f) == k for f, k in zip(found, batch["key"].to_pylist())]
            columns = [*batch.columns[:-1], pa.array([f.tobytes() for f in found], pa.binary())]
            names = [*batch.schema.names[:-1], "shingles"]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(own, pa.bool_()))

    return run


# Comparing


def labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place of the component of each of n places, by edges a - b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _whole(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Sorted batches cut anew between groups of equal keys, with some rows in each."""
    held: list[pa.RecordBatch] = []
    n = 0

    def last_start(table: pa.Table) -> int:
        """Where the last group begins."""
        ends = [table[k].combine_chunks() for k in keys]
        final = [e[len(e) - 1] for e in ends]
        at = table.num_rows - 1
        while at > 0 and all(e[at - 1] == f for e, f in zip(ends, final)):
            at -= 1
        return at

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held)
            at = last_start(table)
            if at:
                yield table.slice(0, at)
            held = table.slice(at).combine_chunks().to_batches()
            n = table.num_rows - at
    if n:
        yield pa.Table.from_batches(held)


def _group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        values = np.array(table[k].to_pylist(), object)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _agreement(threshold: float) -> int:
    """Places of its sketch that a similar pair agrees on, with next to no exception."""
    spread = math.sqrt(threshold * (1 - threshold) / SKETCH)
    return math.floor(SKETCH * (threshold - _MARGIN * spread))


def _compare(threshold: float) -> Callable:
    least = _agreement(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, ["node"], 20_000):
            n = table.num_rows
            node = table["node"].to_numpy()
            size = table["size"].to_numpy().astype(float)
            keys = np.array(table["key"].to_pylist(), object)
            raw = b"".join(table["sketch"].to_pylist())
            marks = np.frombuffer(raw, np.uint8).reshape(n, SKETCH)
            left, right = [], []
            at = np.arange(n - 1)
            step = 1
            while len(at):  # pairs ``step`` places apart in one node
                at = at[at + step < n]
                at = at[node[at] == node[at + step]]
                a, b = size[at], size[at + step]
                fits = np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9
                i = at[fits]
                i = i[(marks[i] == marks[i + step]).sum(axis=1) >= least]
                left.append(i)
                right.append(i + step)
                step += 1
            a, b = np.concatenate(left or [at]), np.concatenate(right or [at])
            label = labels(n, a, b)
            tied = np.flatnonzero(label != np.arange(n))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[tied].tolist(), pa.binary()),
                    pa.array(keys[label[tied]].tolist(), pa.binary()),
                ],
                ["a", "b"],
            )

    return run


def common(sets: list[np.ndarray]) -> np.ndarray:
    """The number of common elements of each two sets."""
    m = len(sets)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    row, column = row[shared], column[shared]
    names, column = np.unique(column, return_inverse=True)
    out = np.zeros((m, m), np.float64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for i in range(0, len(names), 4096):
        low, high = np.searchsorted(column, [i, i + 4096])
        part = np.zeros((m, 4096), np.float32)
        part[row[low:high], column[low:high] - i] = 1
        out += part @ part.T
    return out


def _tiles(threshold: float) -> Callable:
    names = ["key", "links", "other"]

    def one(block, keys, weight, sets, i, j) -> tuple[list, list, list]:
        size = np.array([len(s) for s in sets], float)
        both = common(sets)
        similar = both >= threshold * (size[:, None] + size - both) - 1e-9
        np.fill_diagonal(similar, False)
        if i != j:
            similar &= block[:, None] != block
        links = similar @ weight
        a, b = np.nonzero(np.triu(similar))
        label = labels(len(keys), a, b)
        other = [keys[x] if x != p else None for p, x in enumerate(label)]
        return keys, links.tolist(), other

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, ["root", "i", "j"], 1):
            starts = _group_starts(table, ["root", "i", "j"])
            keys = table["key"].to_pylist()
            block, weight = table["block"].to_numpy(), table["weight"].to_numpy()
            i, j = table["i"].to_numpy(), table["j"].to_numpy()
            data = table["shingles"]
            out: tuple[list, list, list] = ([], [], [])
            for low, high in zip(starts, [*starts[1:], len(keys)]):
                if high - low < 2:
                    continue
                sets = [np.frombuffer(x.as_py(), np.uint64) for x in data[int(low) : int(high)]]
                part = slice(low, high)
                made = one(block[part], keys[part], weight[part], sets, i[low], j[low])
                for column, values in zip(out, made):
                    column.extend(values)
            types = [pa.binary(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return run
