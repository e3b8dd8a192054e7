"""Periodic runs against a comparison of all words."""

import hashlib
import random

import pyarrow as pa
import pytest

from ferryline.llm import periodic as P


def brute(words):
    """All runs (start, length, period) by comparing each two words."""
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(6, 4 * p):
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    n = rng.randint(0, 150)
    words = [f"w{rng.randrange(rng.choice([1, 2, 3, 50]))}" for _ in range(n)]
    if words and rng.random() < 0.6:
        p = rng.randint(1, 35)
        words = words[: rng.randint(0, 10)] + words[:p] * rng.randint(1, 40) + words[5:15]
    return words


def test_cover_takes_any_two_places_to_samples():
    assert {(a - b) % P.V for a in P.COVER for b in P.COVER} == set(range(P.V))


@pytest.mark.parametrize("seed", range(4))
def test_extensions_equal_direct_comparison(seed):
    rng = random.Random(seed)
    words = [rng.randrange(2) for _ in range(40)] * 12 + [5] * 90 + [rng.randrange(3) for _ in range(300)]
    import numpy as np

    ext = P.Extensions(np.array(words))
    n = len(words)
    a = np.array([rng.randrange(n + 1) for _ in range(3000)])
    b = np.array([rng.randrange(n + 1) for _ in range(3000)])
    a, b = a[a != b], b[a != b]

    def direct(i, j):
        k = 0
        while i + k < n and j + k < n and words[i + k] == words[j + k]:
            k += 1
        return k

    assert ext.common(a, b).tolist() == [direct(i, j) for i, j in zip(a.tolist(), b.tolist())]


@pytest.mark.parametrize("seed", range(3))
def test_runs_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    docs = [random_words(rng) for _ in range(120)]
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(w)) for i, w in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for row in P.periodic_runs(df).collect():
        words = docs[row["doc_id"]]
        runs = [tuple(r) for r in row["runs"]]
        assert runs == brute(words), words
        assert (row["n_words"], row["collapsed"]) == (len(words), collapsed(words, runs))


def test_grid_in_blocks_and_long_documents(monkeypatch):
    monkeypatch.setattr(P, "PLACES", 64)
    monkeypatch.setattr(P, "WORDS", 300)
    rng = random.Random(9)
    docs = [random_words(rng) for _ in range(60)] + [["a", "b", "c"] * 700 + ["d"] * 900]
    texts = pa.array([" ".join(d) for d in docs])
    made = [m for part in P._documents(texts) for m in P._found(part)]
    runs = [[(r["start"], r["length"], r["period"]) for r in m[1]] for m in made]
    assert runs[:-1] == [brute(d) for d in docs[:-1]]
    assert runs[-1] == [(0, 2100, 3), (2100, 900, 1)]


def test_odd_rows(spark, odd, nothing):
    found = P.periodic_runs(odd).collect()
    assert len(found) == odd.count()
    by_text = {(r["doc_id"], r["n_words"]): r for r in found}
    for doc in (3, 4, 5):
        assert (by_text[doc, 0]["runs"], by_text[doc, 0]["collapsed"]) == ([], "")
    assert by_text[None, 0]["collapsed"] == ""
    assert [tuple(r) for r in by_text[7, 20_000]["runs"]] == [(0, 20_000, 1)]
    assert by_text[7, 20_000]["collapsed"] == "word"
    assert sum(r["doc_id"] == 1 for r in found) == 2
    assert P.periodic_runs(nothing).collect() == []


def test_planted_repeats(spark, documents, tmp_path):
    """The query's change of texts, word by word."""
    import zlib

    from ferryline.llm import structure_queries as S

    given = {r["doc_id"]: (r["text"] or "").encode().split() for r in documents.collect()}
    for row in S._planted(documents).collect():
        words, h = given[row["doc_id"]], zlib.crc32(str(row["doc_id"]).encode())
        want = list(words)
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            want = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert (row["text"] or "").encode().split() == want


def test_digests(spark, documents):
    from ferryline.llm import structure_queries as S

    rows = S.op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: (r["text"] or "").split() for r in S._planted(documents).collect()}
    for row in rows:
        runs = brute(texts[row["doc_id"]])
        said = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert row["runs_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert row["n_runs"] == len(runs)
