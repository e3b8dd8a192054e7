from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ferryline.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_allocation_rules():
    borders = np.array([0, 3, 5, 10])
    starts, stops = np.array([0, 2, 4, 9]), np.array([2, 4, 9, 10])
    for rule, want in (("first", [2, 1, 1]), ("last", [1, 1, 2]), ("most", [2, 0, 2])):
        n, crossing = token_counts.allocate(borders, starts, stops, rule)
        assert n.tolist() == want
        assert crossing.tolist() == [1, 2, 1]


def test_empty_parts_get_nothing():
    n, crossing = token_counts.allocate(
        np.array([0, 0, 4, 4, 4, 6, 6]), np.array([0, 2]), np.array([2, 6]), "most"
    )
    assert n.tolist() == [0, 2, 0, 0, 0, 0] and crossing.tolist() == [0, 1, 0, 0, 1, 0]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_counts_equal_offsets_of_the_library(documents, rule):
    """ASCII documents, where the library's character offsets are bytes."""
    tokenizer = Tokenizer.from_file(PATH)
    df = documents.where("lang = 'en'")
    got = defaultdict(dict)
    for r in token_counts.count(df, PATH, rule=rule).collect():
        got[r.doc_id][r.section] = (r.start, r.stop, r.n_tokens)
    for row in df.collect():
        if not row.text.isascii():
            continue
        lines = row.text.splitlines(keepends=True)
        stops = np.cumsum([len(line) for line in lines])
        want = np.zeros(len(lines), int)
        for start, stop in tokenizer.encode(row.text, add_special_tokens=False).offsets:
            touched = [max(0, min(stop, e) - max(start, e - len(s))) for s, e in zip(lines, stops)]
            places = np.flatnonzero(touched)
            place = {"first": places[0], "last": places[-1], "most": int(np.argmax(touched))}[rule]
            want[place] += 1
        assert [got[row.doc_id][i][2] for i in range(len(lines))] == want.tolist()
        assert [got[row.doc_id][i][1] for i in range(len(lines))] == stops.tolist()


def test_sections_add_up_to_documents(documents, odd):
    tokenizer = Tokenizer.from_file(PATH)
    for df in (documents, odd.where("doc_id is not null and doc_id not in (1, 2)")):
        totals = defaultdict(int)
        for r in token_counts.count(df, PATH).collect():
            totals[r.doc_id] += r.n_tokens
        want = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in df.collect()}
        assert totals == want


def test_fields_and_their_sections(odd):
    rows = token_counts.count(odd.where("doc_id = 9"), PATH, ("source", "text", "norm")).collect()
    rows.sort(key=lambda r: (r.start, r.stop))
    assert [r.field for r in rows] == ["source", "text", "norm"]
    assert all(a.stop == b.start for a, b in zip(rows, rows[1:]))


def test_odd_tables(odd, nothing):
    assert token_counts.count(nothing, PATH).count() == 0
    assert token_counts.count(odd, PATH).count() >= odd.count()
    with pytest.raises(ValueError):
        token_counts.count(odd, PATH, rule="half")
    with pytest.raises(ValueError):
        token_counts.count(odd, PATH, fields=())
