import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


# Cases every operator must bear: nulls, empty and long texts, ties, repeated rows.
ODD = [
    (1, "one two three four five six seven", "a"),
    (1, "one two three four five six seven", "a"),
    (2, "one two three four five six seven", None),
    (2, "another text with the same id as another", "b"),
    (3, None, None),
    (4, "", "c"),
    (5, " \t\n ", "c"),
    (None, "a row without an id", "a"),
    (None, None, None),
    (6, "x", "a"),
    (7, "word " * 20_000, "a"),
    (8, "y" * 50_000, "a"),
    (9, "日本語 \u0001 \U0001f600 </s> <|endoftext|> 12 " * 3, "d"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with more columns, among them names that operators use inside."""
    rows = [(i, t, s, "fr", 1, 2, "n") for i, t, s in ODD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, lang string, run int, key int, norm string"
    )


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
