"""Every query against its SQL in DuckDB at the smallest scale."""

import datetime
import importlib
import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from ferryline import suite

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

QUERIES = suite.queries()
ORACLE = suite.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (datetime.date, datetime.time)):
        return value.isoformat()
    return value


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(type(v)), v) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = [tuple(plain(r[i]) for i in order) for r in cursor.fetchall()]
    assert ordered(got) == ordered(want)
    assert got


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["batch_number", "row_count"]
    assert df.count() == 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_optional_parts_may_be_missing(monkeypatch):
    """The entry points work without the optional parts, but do not hide other faults."""
    real = importlib.import_module

    def without(name):
        if name == "ferryline.llm.suite":
            raise ModuleNotFoundError("gone", name="ferryline.llm")
        if name == "corpus_pipeline":
            raise ModuleNotFoundError("gone", name="corpus_pipeline")
        return real(name)

    monkeypatch.setattr(entry_points.importlib, "import_module", without)
    assert set(entry_points.queries()) == set(QUERIES)

    def broken(name):
        raise ModuleNotFoundError("gone", name="numpy")

    monkeypatch.setattr(entry_points.importlib, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):
        entry_points.queries()
