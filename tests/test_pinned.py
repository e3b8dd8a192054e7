"""Column lists against FIXTURES.md, which was taken down apart from the specs."""

import re
from pathlib import Path

import pytest

from ferryline.feeds import FEEDS
from ferryline.feeds.record_feeds import ASSET_TABLES, PLAN_PARTS
from ferryline.plans.flight_plans import DOCUMENT, LISTS, ROOT, STRUCTS

TEXT = (Path(__file__).resolve().parents[1] / "FIXTURES.md").read_text()
SECTIONS = dict(re.findall(r"^### (\w+).*?\n\n(.*?)(?=^#|\Z)", TEXT, re.M | re.S))

CSV = [code for code, spec in FEEDS.items() if spec.source == "csv"]
# This feed's value has the name of another feed's in the source; it is renamed on purpose.
RENAMED = {("F39", "respData"): "temperature"}


def kind(name):
    """A type as written there, as the specs write it; None if it is not known."""
    name = re.sub(r"\(.*", "", name).lower()
    return {"number*": "double", "char": "string", "?": None}.get(name, name)


def listed(section):
    """(name, type) of the columns of a section, without those the job adds."""
    body = SECTIONS[section].split("columns", 1)[1].split(":", 1)[1]
    found = re.findall(r"\b(\w+) ([A-Z]+(?:\([\d, ]+\))?|number\*|\?)(?=,|\n|$|;)", body.split("\n")[0] + "\n")
    return [(n, kind(t)) for n, t in found if n not in ("import_id", "root_id")]


def same(got, want):
    assert [n for n, _ in got] == [n for n, _ in want]
    assert [t for _, t in got] == [w or t for (_, t), (_, w) in zip(got, want)]


@pytest.mark.parametrize("code", CSV)
def test_csv_columns(code):
    line = re.search(r"File columns, in order: (.*)", SECTIONS[code])[1]
    columns = re.findall(r"`(\w+)` (\w+\*?)( \(not stored[^)]*\))?", line)
    want = [(RENAMED.get((code, n), n), kind(t), not dropped) for n, t, dropped in columns]
    assert [(f.source, f.source_type, f.target is not None) for f in FEEDS[code].fields] == want


@pytest.mark.parametrize(
    "code,section",
    [("F44", "eeg_emg"), ("F45", "eye_tracking"), ("F46", "joint_posture"), ("F47", "illuminance"),
     ("F48", "sorties_batch"), ("F49", "sorties"), ("F50", "personnel_info"), ("F51", "personnel_info")],
)
def test_record_columns(code, section):
    same([(f.target, f.target_type) for f in FEEDS[code].stored], listed(section))


@pytest.mark.parametrize("table", PLAN_PARTS)
def test_plan_columns(table):
    same([(f.target, f.target_type) for f in PLAN_PARTS[table]], listed(table))


def test_plan_document():
    assert [f.name for f in DOCUMENT] == [*ROOT.names, *STRUCTS, *LISTS]
    assert ROOT.names == [n for n, _ in listed("flight_plan_root")]


@pytest.mark.parametrize("spec", ASSET_TABLES, ids=lambda s: s.table)
def test_asset_columns(spec):
    same([(f.target, f.target_type) for f in spec.stored], listed(spec.table))


@pytest.mark.parametrize("code", ["F55", "F56"])
def test_change_log_columns(code):
    spec = FEEDS[code]
    source, target = listed(f"{spec.table}_source"), listed(f"{spec.table}_target")
    assert sorted((f.source, f.source_type) for f in spec.fields) == sorted(source)
    assert sorted((f.target, f.target_type) for f in spec.stored) == sorted(target)


def test_a_swapped_pair_of_columns_would_be_seen():
    spec = FEEDS["F01"]
    swapped = [spec.fields[1], spec.fields[0], *spec.fields[2:]]
    with pytest.raises(AssertionError):
        same([(f.source, f.source_type) for f in swapped], [(f.source, f.source_type) for f in spec.fields])
