import numpy as np
import pytest

from ferryline.llm import neighbours
from ferryline.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", 2) for i, v in rows], SCHEMA)


def brute(rows, queries, k):
    usable = sorted({
        (i, tuple(v)) for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    })
    out = {}
    for q, v in usable:
        if q not in queries:
            continue
        scored = [
            (-float(np.dot(np.float32(v).astype(float), np.float32(w).astype(float))), i)
            for i, w in usable
            if i != q and len(w) == len(v)
        ]
        out[q] = [i for _, i in sorted(scored)[:k]]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append(r.vec_id)
    return out


def search(df, queries, k=5, **options):
    return result(neighbours.search(neighbours.build(df, k, **options), queries, k))


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.integers(-4, 5, 6) * (1 + i % 3)).astype(float).tolist()) for i in range(300)]
    df = frame(spark, rows)
    queries = {i for i, _ in rows if i % 20 == 0}
    want = brute(rows, queries, 5)
    assert search(df, df.where("vec_id % 20 = 0")) == want
    assert search(df, df.where("vec_id % 20 = 0"), shard=60) == want


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, []),
        (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [None, 1.0]),
        (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (20, [-1.0, -1.0]), (40, None), (60, [3.0]),
    ]
    df = frame(spark, rows)
    found = search(df, df.where("vec_id % 20 = 0 or vec_id is null"))
    assert found == {0: [1, 2, 20], 20: [0, 1, 2][::-1][:1] + [0, 1]} or found == brute(rows, {0, 20}, 5)
    assert 40 not in found and 60 not in found


def test_many_copies_of_one_vector(spark):
    rows = [(i, [1.0, 2.0]) for i in range(500)] + [(i, [1.0, float(i % 7)]) for i in range(500, 520)]
    df = frame(spark, rows)
    queries = {i for i, _ in rows if i % 20 == 0}
    assert search(df, df.where("vec_id % 20 = 0")) == brute(rows, queries, 5)


def test_empty(spark):
    df = frame(spark, [])
    assert search(df, df) == {}
    one = frame(spark, [(20, [1.0, 2.0])])
    assert search(one, one) == {}


def test_recall_and_scores_on_the_table(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    queries = vectors.where("vec_id % 100 = 0")
    got = {(r.query_id, r.vec_id): r.score for r in neighbours.search(neighbours.build(vectors), queries).collect()}
    want = {(r.query_id, r.vec_id): r.score for r in neighbours.exact(vectors, queries).collect()}
    both = set(got) & set(want)
    assert len(both) >= 0.95 * len(want)
    assert all(got[p] == pytest.approx(want[p], abs=1e-12) for p in both)


def test_pruning_keeps_spread_neighbours():
    x = np.array([[0.0, 0], [1, 0], [1.1, 0], [0, 2]])
    graph = neighbours.Graph(x, np.full((4, neighbours.SLACK), -1))
    kept = graph.pruned(np.array([0]), np.array([[1, 2, 3, -1, 0, 1]]))[0]
    assert kept[kept >= 0].tolist() == [1, 3]
