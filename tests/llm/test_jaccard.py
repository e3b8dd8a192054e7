import random
from collections import defaultdict

import numpy as np
import pytest

from ferryline.llm import jaccard
from ferryline.llm.components import components


def sets_of(rows, words=5):
    out = []
    for doc_id, text in rows:
        parts = [p for p in (text or "").lower().encode().split()]
        n = min(len(parts), words)
        found = {tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)} if n else set()
        out.append((doc_id, found))
    return out


def brute(rows, threshold=0.8):
    """(id, class, links) of each row, by comparing all."""
    sets = [(i, s) for i, s in sets_of(rows)]
    part = [i is not None and bool(s) for i, s in sets]
    n = len(sets)
    near = defaultdict(set)
    for a in range(n):
        for b in range(a):
            if part[a] and part[b]:
                both = len(sets[a][1] & sets[b][1])
                if both >= threshold * (len(sets[a][1]) + len(sets[b][1]) - both) - 1e-9:
                    near[a].add(b)
                    near[b].add(a)
    out = []
    for a in range(n):
        reach, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()] - reach:
                reach.add(b)
                todo.append(b)
        least = None if sets[a][0] is None else min(sets[b][0] for b in reach)
        out.append((sets[a][0], least, len(near[a])))
    return sorted(out, key=repr)


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"e{rng.random()}"
    return " ".join(words)


def corpus(seed):
    """Groups of copies with more and more edits, a shared passage, and other texts."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for g in range(25):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([3, 8, 40, 150]))]
        base = base + passage if g % 3 == 0 else base
        texts += [edited(rng, base, k % 5) for k in range(rng.choice([1, 2, 6]))]
    crowd = [f"c{i}" for i in range(120)]
    texts += [edited(rng, crowd, 1 + k % 3) for k in range(70)]
    texts += texts[:5] * 3
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_and_links_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "SMALL", 12)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted([tuple(r)[:3] for r in jaccard.join(df).collect()], key=repr)
    assert got == brute(rows)


def test_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = jaccard.join(odd).collect()
    assert sorted([tuple(r)[:3] for r in found], key=repr) == brute(rows)
    assert all(r.kept for r in found if r.doc_id is None)
    kept = [r.doc_id for r in found if r.kept and r.doc_id is not None]
    assert all(r.doc_id == r.class_id for r in found if r.kept)
    # 1 stands for three rows; 2 for its other text; 3, 4 and 5 have no words.
    assert sorted(kept) == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert jaccard.join(nothing).count() == 0


def test_one_row_of_a_class_is_kept(spark):
    """Rows with one id: two with equal texts, one in capitals, and one with another text."""
    text = "some words that are here to be told apart from others"
    rows = [(1, text), (1, text), (1, text.upper()), (2, text), (1, "another text of six words here")]
    found = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.class_id for r in found] == [1] * 5
    assert sorted(r.links for r in found) == [0, 3, 3, 3, 3]
    # Two classes of one name, as an id repeats: each keeps a row.
    assert sorted(r.links for r in found if r.kept) == [0, 3]


def test_runs_follow_from_the_target():
    assert jaccard.runs_needed(0.9) < jaccard.runs_needed(0.99) < jaccard.runs_needed(0.9999)


def test_recall_of_meetings_at_the_threshold():
    """Pairs just at the threshold share a full path about as often as promised."""
    rng = np.random.default_rng(0)
    n_runs, met = jaccard.runs_needed(0.995), 0
    for _ in range(400):
        # 80 of 100 shingles in common out of 90 and 90: 0.8.
        x = rng.integers(0, 2**63, 100, dtype=np.uint64)
        a, b = np.unique(x[:90]), np.unique(x[10:])
        pa, pb = ({p for p in jaccard.paths(s, 0.8, n_runs) if len(p) == 3} for s in (a, b))
        met += bool(pa & pb)
    assert met >= 0.98 * 400


@pytest.mark.parametrize("shared, size", [(4, 5), (8, 10)])
def test_recall_of_meetings_of_short_texts(shared, size):
    """Small sets do not run out of shingles: they share a full path as often as promised."""
    rng = np.random.default_rng(1)
    n_runs, met, n = jaccard.runs_needed(0.995), 0, 2000
    for _ in range(n):
        x = rng.integers(0, 2**63, size, dtype=np.uint64)
        a, b = np.unique(x[:shared]), np.unique(x)
        pa, pb = ({p for p in jaccard.paths(s, 0.8, n_runs) if len(p) == 3} for s in (a, b))
        met += bool(pa & pb)
    assert met >= 0.995 * n


def test_hot_sets_with_few_shingles(spark, monkeypatch):
    """A set of one or two shingles in a large node is compared, though it has no child."""
    monkeypatch.setattr(jaccard, "SMALL", 4)
    rows = [(0, "a b c d e"), (1, "a b c d e f")]
    rows += [(2 + i, f"a b c d e x{i}") for i in range(9)] + [(20 + i, f"a b c d e f x{i}") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted([tuple(r)[:3] for r in jaccard.join(df, threshold=0.5).collect()], key=repr)
    assert got == brute(rows, 0.5)


def test_common_counts():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(9)] + [np.arange(9000, dtype=np.uint64)]
    got = jaccard.common(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(np.intersect1d(a, b))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (301, 300)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {300: 300, 301: 300}
    assert {r.node: r.root for r in found} == want
    assert len(found) == len(want)


def test_threshold_is_checked(odd):
    with pytest.raises(ValueError):
        jaccard.join(odd, threshold=0)
