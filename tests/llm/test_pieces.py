import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from ferryline.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)

PARTS = [
    "a", "e", "t", "th", "the", "▁", " ", "  ", "\n", "ing", "日", "\U0001f600", "<s>", "</s>",
    "<0x0A>", "1", "00", "é", "ß", "...", "==", "\t", " " * 17, "x" * 9, "Ö", ".", ",",
]


def ids(text):
    return np.frombuffer(pieces.transducer(PATH).encode(text), "<i4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_ids_and_texts_are_those_of_the_library(text):
    assert ids(text) == LIBRARY.encode(text)
    assert pieces.transducer(PATH).decode(ids(text)) == LIBRARY.decode(ids(text))


@pytest.mark.parametrize(
    "said",
    [
        "我们今天在这里讨论一种新的方法并且给出所有结果。",
        "ภาษาไทยเขียนติดกันโดยไม่มีช่องว่างระหว่างคำ",
        "\U0001f600",
        "§",
        "ä",
        "日本語abcのtheテキスト,ing",
    ],
)
def test_long_texts_without_spaces(said):
    text = (said * 5000)[:5000]
    assert ids(text) == LIBRARY.encode(text)
    assert ids(f"so {text} it") == LIBRARY.encode(f"so {text} it")


def test_weights_forbid_what_merges_would_join():
    t = pieces.transducer(PATH)
    path = t.shortest("▁thening")
    assert all(t.apart(a, b) for a, b in zip(path, path[1:]))
    assert not t.apart("▁t", "h")


def test_stores_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_WORDS", 3)
    monkeypatch.setattr(pieces, "KNOWN_PAIRS", 3)
    t = pieces.Transducer(PATH)
    text = "some more words than the store has places for, and pairs of them"
    assert np.frombuffer(t.encode(text), "<i4").tolist() == LIBRARY.encode(text)
    assert len(t.inner) <= 3 and t.n_pairs <= 3


def test_tables(documents, odd, nothing):
    for df in (documents, odd):
        texts = sorted((r.doc_id or -1, r.text or "") for r in df.collect())
        coded = pieces.encode(df, PATH)
        got = sorted((r.doc_id or -1, r.text) for r in pieces.decode(coded, PATH).collect())
        assert got == texts
        by_text = {t: LIBRARY.encode(t) for _, t in texts}
        rows = sorted((r.doc_id or -1, r.ids, r.n_tokens) for r in coded.collect())
        assert rows == sorted((i, by_text[t], len(by_text[t])) for i, t in texts)
    assert pieces.encode(nothing, PATH).count() == 0


def test_null_ids_decode_to_null(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, [], "y")], "doc_id int, ids array<int>, text string")
    found = {r.doc_id: r.text for r in pieces.decode(df, PATH).collect()}
    assert found == {1: None, 2: ""}
