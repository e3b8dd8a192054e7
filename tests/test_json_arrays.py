"""JSON arrays in splits, against a parser that reads each file whole."""

import json
import random

import pytest

from ferryline.sources import json_array_splits
from ferryline.sources.json_arrays import PLACE, _offsets, _pieces

SCHEMA = "n BIGINT, s STRING, o STRUCT<s: STRING, l: ARRAY<STRUCT<n: BIGINT>>>"


@pytest.fixture(params=[40, 300, 1 << 20])
def split_bytes(request, spark):
    """Splits of few bytes, so that strings, escapes and elements go over their borders."""
    settings = {
        "spark.sql.files.maxPartitionBytes": str(request.param),
        "spark.sql.files.openCostInBytes": "1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def random_record(rng):
    def text():
        return "".join(rng.choice('}{][",:\\ \n\tab\'é😀') for _ in range(rng.randint(0, 30)))

    return {
        "n": rng.randint(-9, 9),
        "s": rng.choice([None, text(), text()]),
        "o": rng.choice([None, {"s": text(), "l": [{"n": i} for i in range(rng.randint(0, 4))]}]),
    }


LAYOUTS = [{"indent": 2}, {"separators": (",", ":")}, {"indent": 0, "ensure_ascii": False}, {}]


def test_any_layout_in_any_splits(spark, tmp_path, split_bytes):
    rng = random.Random(split_bytes)
    want = []
    for i, layout in enumerate(LAYOUTS * 2):
        records = [random_record(rng) for _ in range(rng.choice([0, 1, 7, 12]))]
        given = [r for record in records for r in ([None, record] if rng.random() < 0.2 else [record])]
        if rng.random() < 0.5:
            given.append(None)
        text = json.dumps(given, **layout)
        (tmp_path / f"{i}.json").write_text(rng.choice(["", "\n "]) + text + rng.choice(["", "\n", " \n\n"]))
        want.append(records)
    found = json_array_splits(spark, str(tmp_path), SCHEMA, place=True)
    rows = sorted(found.collect(), key=lambda r: [r[c] for c in PLACE[1:]])
    for i, records in enumerate(want):
        own = [r.asDict(recursive=True) for r in rows if r["_file"].endswith(f"/{i}.json")]
        for record in own:
            for c in PLACE:
                del record[c]
        assert own == records
    if split_bytes == 40:
        assert len({(r["_file"], r["_block"]) for r in rows}) > 2 * len(want)


@pytest.mark.parametrize(
    "text",
    [
        '[{"n": 1}, {"n": 2}',
        '[{"n": 1}, {"n": 2',
        '[{"n": 1}, {"s": "open}',
        '{"n": 1}',
        '[{"n": 1}] {"n": 2}',
        '[{"n": 1}, 5, {"n": 2}]',
        '[[{"n": 1}]]',
        '[{"n": "x"}]',
        "[1, 2]",
        "nothing",
    ],
)
def test_other_files_fail(spark, tmp_path, split_bytes, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception):
        json_array_splits(spark, str(tmp_path), "n BIGINT, s STRING").collect()


def test_no_elements(spark, tmp_path):
    for i, text in enumerate(("[]", " [ \n ] \n", "[null]", "[null, null ]", "")):
        (tmp_path / f"{i}.json").write_text(text)
    assert json_array_splits(spark, str(tmp_path), "n BIGINT").collect() == []


def test_elements_within_a_split_are_shuffled_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"n": 1}]')
    df = json_array_splits(spark, str(tmp_path), "n BIGINT")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The text's way to its split; the rest are totals of splits and parts at their borders.
    wide = [line for line in plan.splitlines() if "Exchange" in line and "_block" in line]
    assert len(wide) <= 6 and "SinglePartition" not in plan


def test_text_is_not_shuffled_within_splits(spark, tmp_path):
    """Pieces of text go from the reader to the elements in order, without exchange or sort."""
    (tmp_path / "a.json").write_text(json.dumps([{"n": i, "s": "x"} for i in range(50)]))
    found = json_array_splits(spark, str(tmp_path), SCHEMA, place=True)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = found._jdf.queryExecution().explainString(mode)
    steps = [p for p in plan.split("\n\n") if p.startswith("(") and ("Exchange" in p or " Sort" in p)]
    assert any("begins_inside" in p for p in steps)
    assert not [p for p in steps if "value#" in p]
    assert [r.n for r in found.orderBy("_row").collect()] == list(range(50))


def test_whole_files_need_no_totals(spark, tmp_path, split_bytes):
    """Only splits of files with several are gone through beforehand."""
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps([{"n": n, "s": "x"} for n in range(5 * i + 1)]))
    splits = _pieces(spark, str(tmp_path)).select("_file", "_block").distinct().count()
    assert _offsets(_pieces(spark, str(tmp_path))).count() == (0 if splits == 3 else splits - 1)
    assert json_array_splits(spark, str(tmp_path), SCHEMA).count() == 18
