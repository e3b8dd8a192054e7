"""Approximate nearest neighbours by inner product, on robust-pruned directed graphs.

Vectors are dealt to shards of bounded size by a hash. In each shard a graph is grown:
greedy search proposes neighbours for a new node, and pruning with relaxed distances keeps
those that lead in different directions. Every query searches the graph of every shard with
a beam, in blocks of queries, and the best of all shards are its neighbours.

The largest inner product becomes the smallest distance by one more coordinate, which
gives all vectors of a shard the same length and a query zero there.

Equal vectors are one node of the graph that carries the smallest ids, as many as a result
can need, so any number of copies of a vector costs one node.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.common import staged

K = 20
SHARD, BLOCK = 8192, 4096  # vectors of a shard, queries of a block
DEGREE, SLACK, RELAXED = 32, 48, 1.2
BUILD_BEAM, BEAM = 64, 96
_BATCH, _WIDTH = 256, 4

INDEX = "dim int, shard int, node int, v array<double>, ids array<long>, links array<int>"


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, empty or zero, all parts finite numbers."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    return rows.where(F.col("id").isNotNull() & usable("v")).distinct()


def _tasks(df: DataFrame, groups: int) -> int:
    """Partitions for so many groups: given, so that small but costly ones stay apart, and
    no more than a cluster can use."""
    most = 32 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(2 * groups, most))


def build(
    df: DataFrame,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard: int = SHARD,
) -> DataFrame:
    """The index of all usable vectors, one row for each different one, written to files.

    Rows without an id take no part, and repeated rows count once. Vectors of different
    length get shards of their own. An empty table gives an empty index.
    """
    rows = _rows(df, id_col, vector_col)
    # Of many copies of a vector the k + 1 smallest ids can be results, and no others.
    order = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.withColumn("place", order).where(F.col("place") <= k + 1)
    nodes = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    nodes = staged(nodes.withColumn("dim", F.size("v")), "vectors")
    n_shards = max(1, -(-nodes.count() // shard))
    keyed = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(n_shards)).cast("int"))
    dealt = keyed.repartition(_tasks(df, n_shards), "dim", "shard")
    return staged(dealt.groupBy("dim", "shard").applyInPandas(_grow, INDEX), "index")


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    beam: int = BEAM,
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` nearest found for each usable query, never the row with the query's own id.

    Returns query_id, rank from 1, vec_id and score, the inner product in double precision;
    ties go to the smaller vec_id. A query that is not usable, or finds no vector of its
    length, has no rows. With fewer than k candidates all are returned.
    """
    asked = staged(_rows(queries, id_col, vector_col), "queries")
    n_blocks = max(1, -(-asked.count() // block))
    shards = index.select(F.col("dim").alias("d"), F.col("shard").alias("s")).distinct()
    left = (
        asked.withColumn("dim", F.size("v"))
        .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int"))
        .join(shards, F.col("dim") == F.col("d"))
        .select("dim", F.col("s").alias("shard"), "block", "id", "v")
    )
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    right = index.withColumn("block", blocks)
    n_tasks = _tasks(index, n_blocks * shards.count())
    key = ["dim", "shard", "block"]
    pairs = (
        left.repartition(n_tasks, *key)
        .groupBy(*key)
        .cogroup(right.repartition(n_tasks, *key).groupBy(*key))
    )
    found = pairs.applyInPandas(_ask(k, beam), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def exact(
    df: DataFrame,
    queries: DataFrame,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The same by comparing with every row; for measuring recall on small tables."""
    every = _rows(df, id_col, vector_col).select(F.col("id").alias("vec_id"), F.col("v").alias("w"))
    asked = _rows(queries, id_col, vector_col)
    dot = F.aggregate(
        F.zip_with("v", "w", lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x
    )
    pairs = asked.join(every, (F.size("v") == F.size("w")) & (F.col("id") != F.col("vec_id")))
    scored = pairs.select(F.col("id").alias("query_id"), "vec_id", dot.alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


# The graph of one shard


class Graph:
    """A directed graph on the rows of ``x``; -1 fills unused places of ``links``."""

    def __init__(self, x: np.ndarray, links: np.ndarray):
        self.x, self.links = x, links

    def beam(self, q: np.ndarray, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest found for each row of ``q`` among the first ``n`` nodes.

        Returns nodes (-1 where there are fewer) and inner products, best first. All rows
        step together; in each step a row follows its best nodes not followed so far.
        """
        rows = len(q)
        own = np.arange(rows)[:, None]
        seen = np.zeros((rows, n), bool)
        seen[:, 0] = True
        nodes = np.full((rows, size), -1)
        score = np.full((rows, size), -np.inf)
        nodes[:, 0], score[:, 0] = 0, q @ self.x[0]
        followed = np.ones((rows, size), bool)
        followed[:, 0] = False
        live = np.arange(rows)
        while len(live):
            at = own[: len(live)]
            # The first few open places of each row; places are in order of score.
            open_places = np.argsort(followed[live], axis=1, kind="stable")[:, :_WIDTH]
            is_open = ~followed[live[:, None], open_places]
            followed[live[:, None], open_places] = True
            going = nodes[live[:, None], open_places]
            new = np.where(is_open[..., None], self.links[going], -1).reshape(len(live), -1)
            new[(new < 0) | seen[live[:, None], new]] = -1
            # A node may be reached from two others in one step.
            new = -np.sort(-new, axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            width = max(1, int((new >= 0).sum(axis=1).max()))
            new = -np.sort(-new, axis=1)[:, :width]
            valid = new >= 0
            seen[np.broadcast_to(live[:, None], new.shape)[valid], new[valid]] = True
            fresh = np.einsum("qnd,qd->qn", self.x[new], q[live])
            fresh[~valid] = -np.inf
            all_score = np.concatenate([score[live], fresh], axis=1)
            order = np.argsort(-all_score, axis=1, kind="stable")[:, :size]
            nodes[live] = np.concatenate([nodes[live], new], axis=1)[at, order]
            score[live] = all_score[at, order]
            done = np.concatenate([followed[live], ~valid], axis=1)[at, order]
            followed[live] = done
            live = live[~done.all(axis=1)]
        nodes[np.isneginf(score)] = -1
        return nodes, score

    def pruned(self, points: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Up to DEGREE of the candidates ``near`` of each point that are well spread.

        Candidates are taken by distance; one that is RELAXED times nearer to a node taken
        than to the point is left out.
        """
        x = self.x[near]
        to = ((x - self.x[points][:, None]) ** 2).sum(axis=2)
        to[(near < 0) | (near == points[:, None])] = np.inf
        order = np.argsort(to, axis=1, kind="stable")
        near, to = np.take_along_axis(near, order, 1), np.take_along_axis(to, order, 1)
        to[:, 1:][near[:, 1:] == near[:, :-1]] = np.inf
        x = np.take_along_axis(x, order[..., None], 1)
        norm = (x**2).sum(axis=2)
        apart = norm[:, :, None] + norm[:, None] - 2 * (x @ x.transpose(0, 2, 1))
        covered = RELAXED**2 * apart <= to[:, None]
        alive = np.isfinite(to)
        out = np.full((len(points), DEGREE), -1)
        row = np.arange(len(points))
        for i in range(DEGREE):
            first = alive.argmax(axis=1)
            some = alive[row, first]
            if not some.any():
                break
            out[some, i] = near[row, first][some]
            alive &= ~covered[row, first]
            alive[row, first] = False
        return out


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more coordinate that makes them equally long."""
    square = (vectors**2).sum(axis=1)
    more = np.sqrt(np.maximum(square.max() - square, 0))
    return np.column_stack([vectors, more])


def grow(vectors: np.ndarray) -> np.ndarray:
    """Out-links of each node of a shard, SLACK places wide, -1 where unused."""
    n = len(vectors)
    x = lifted(vectors)
    x = x / max(np.sqrt((x[0] ** 2).sum()), 1e-300)
    graph = Graph(x, np.full((n, SLACK), -1))
    degree = np.zeros(n, np.int64)
    begin = 1
    while begin < n:
        # Batches grow with the graph, so that each finds a graph worth searching.
        points = np.arange(begin, min(n, begin + min(begin, _BATCH)))
        near, _ = graph.beam(x[points], BUILD_BEAM, begin)
        # Nodes of a batch do not find each other by search.
        own = x[points] @ x[points].T
        np.fill_diagonal(own, -np.inf)
        mates = points[np.argsort(-own, axis=1)[:, :8]]
        out = graph.pruned(points, np.concatenate([near, mates], axis=1))
        graph.links[points, :DEGREE] = out
        degree[points] = (out >= 0).sum(axis=1)
        _link_back(graph, degree, points, out)
        begin = int(points[-1]) + 1
    return graph.links


def _link_back(graph: Graph, degree: np.ndarray, points: np.ndarray, out: np.ndarray) -> None:
    """Add the reverse of new links; nodes that get too many are pruned."""
    source = np.repeat(points, out.shape[1])[out.ravel() >= 0]
    target = out.ravel()[out.ravel() >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    heads, starts, counts = np.unique(target, return_index=True, return_counts=True)
    room = degree[heads] + counts <= SLACK
    nth = np.arange(len(target)) - np.repeat(starts, counts)
    fits = np.repeat(room, counts)
    graph.links[target[fits], (degree[target] + nth)[fits]] = source[fits]
    degree[heads[room]] += counts[room]
    full = heads[~room]
    for i in range(0, len(full), _BATCH):
        nodes = full[i : i + _BATCH]
        which = np.searchsorted(heads, nodes)
        more = np.full((len(nodes), int(counts[which].max())), -1)
        for j, w in enumerate(which):
            more[j, : counts[w]] = source[starts[w] : starts[w] + counts[w]]
        kept = graph.pruned(nodes, np.concatenate([graph.links[nodes], more], axis=1))
        graph.links[nodes] = -1
        graph.links[nodes, :DEGREE] = kept
        degree[nodes] = (kept >= 0).sum(axis=1)


# On Spark


def _grow(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    dim, shard = key
    # A random order, but the same one if the task is repeated.
    firsts = np.argsort([ids[0] for ids in frame["ids"]], kind="stable")
    at = firsts[np.random.default_rng(0).permutation(len(frame))]
    vectors = np.stack(frame["v"].to_numpy())[at]
    links = grow(vectors)
    return pd.DataFrame(
        {
            "dim": dim,
            "shard": shard,
            "node": np.arange(len(vectors), dtype=np.int32),
            "v": list(vectors),
            "ids": frame["ids"].to_numpy()[at],
            "links": [row[row >= 0].astype(np.int32) for row in links],
        }
    )


def _ask(k: int, beam: int) -> Callable:
    def ask(asked: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(index):
            index = index.sort_values("node", ignore_index=True)
            vectors = np.stack(index["v"].to_numpy())
            links = np.full((len(index), SLACK), -1)
            for i, row in enumerate(index["links"]):
                links[i, : len(row)] = row
            graph = Graph(lifted(vectors), links)
            queries = np.stack(asked["v"].to_numpy())
            for i in range(0, len(asked), _BATCH):
                part = queries[i : i + _BATCH]
                flat = np.column_stack([part, np.zeros(len(part))])
                nodes, _ = graph.beam(flat, max(beam, k + 1), len(index))
                score = np.einsum("qnd,qd->qn", vectors[nodes], part)
                ids = asked["id"].to_numpy()[i : i + _BATCH]
                out += _results(ids, nodes, score, index["ids"].to_numpy(), k)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    return ask


def _results(queries, nodes, score, ids, k: int) -> Iterator[tuple[int, int, float]]:
    for query, row, values in zip(queries, nodes, score):
        found = []
        worst = -np.inf
        for node, value in sorted(zip(row[row >= 0], values[row >= 0]), key=lambda p: -p[1]):
            if len(found) >= k and value < worst:
                break
            found += [(-value, int(i)) for i in ids[node] if i != query]
            if len(found) >= k:
                worst = -sorted(found)[k - 1][0]
        for value, i in sorted(found)[:k]:
            yield int(query), i, -float(value)
