import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ferryline.llm import packing
from ferryline.llm.bpe import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_are_those_of_the_tokenizers_library(documents, odd):
    tokenizer = Tokenizer.from_file(PATH)
    texts = [r.text or "" for r in documents.collect()] + [r.text or "" for r in odd.collect()]
    texts += ["a<|endoftext|>b", " <|endoftext|> ", "́e  x\n\n y\r\n", "I'll it's 123 ½"]
    for text in texts:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder(PATH).ids(text).tolist() == want


def check(rows, texts, capacity):
    """Every document is there once, whole; sequences are full without gaps."""
    ids = [[*encoder(PATH).ids(t or "").tolist(), 2] for _, t in texts]
    want = Counter()
    for (doc_id, _), own in zip(texts, ids):
        first = (len(own) - 1) % capacity + 1
        starts = [0, *range(first, len(own), capacity)]
        for piece, start in enumerate(starts):
            part = own[start : first if not start else start + capacity]
            crc = zlib.crc32(np.asarray(part, "<u4").tobytes())
            want[doc_id, piece, start, len(part), crc] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [1024, 100])
def test_packed_whole_and_tight(documents, odd, capacity):
    for df in (documents, odd):
        texts = [(r.doc_id, r.text) for r in df.collect()]
        rows = packing.packed(df, PATH, capacity).collect()
        n = check(rows, texts, capacity)
        assert n <= 1.1 * sum(r.length for r in rows) / capacity + 2


def test_plan_places_every_count():
    rng = np.random.default_rng(3)
    totals = dict(enumerate(rng.integers(0, 50, 1024).tolist(), 1))
    totals = {k: v for k, v in totals.items() if v}
    placed = Counter()
    for length, low, high, _, _ in packing.plan(totals, 1024):
        placed[length] += high - low
    assert placed == totals


def test_exchange_for_two_fits_tighter():
    # Greedy takes 6 and 3 of 10 and leaves a gap; 6 with two of 2 fills it.
    slots = packing.plan({6: 1, 3: 1, 2: 2}, 10)
    first = sorted(length for length, _, _, sequence, _ in slots if sequence == 0)
    assert first == [2, 2, 6]


def test_plan_size_does_not_grow_with_counts():
    few = packing.plan({n: 7 * n for n in range(1, 65)}, 64)
    many = packing.plan({n: 7_000_000 * n for n in range(1, 65)}, 64)
    assert len(many) < 2 * len(few) + 500


def test_ids_can_come_along(odd):
    found = packing.pieces(odd, PATH, with_ids=True).collect()
    assert all(len(r.ids) == r.length for r in found)


def test_empty(nothing):
    assert packing.packed(nothing, PATH).count() == 0


def test_bad_capacity(odd):
    with pytest.raises(ValueError):
        packing.pieces(odd, PATH, 0)
