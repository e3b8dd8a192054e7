import pytest

from ferryline.feeds import FEEDS
from ferryline.feeds.record_feeds import ASSET_TABLES, PLAN_PARTS
from ferryline.functions import snake_case
from ferryline.plans import load
from ferryline.plans.run import keyed_table
from ferryline.sinks import read_table
from ferryline.sources import csv_feed

CSV = [spec for spec in FEEDS.values() if spec.source == "csv"]


def test_codes_are_complete():
    assert sorted(FEEDS) == [f"F{i:02d}" for i in range(1, 57)]
    assert len(ASSET_TABLES) == 3


@pytest.mark.parametrize("spec", FEEDS.values(), ids=lambda s: s.code)
def test_columns(spec):
    names = [f.source for f in spec.fields]
    assert len(names) == len(set(names))
    stored = spec.target_schema.names
    assert len(stored) == len(set(stored)) == len(spec.stored) + len(spec.lineage)
    assert set(spec.keys) <= set(stored)
    assert all(name == name.lower() for name in stored)


def test_columns_on_file_and_stored():
    spec = FEEDS["F01"]
    assert len(spec.fields) == 35 and len(spec.target_schema) == 24
    assert "weapon_pylon_id" not in spec.target_schema.names
    assert len(FEEDS["F32"].target_schema) == 48
    assert FEEDS["F32"].target_schema.names[-3:] == ["slant_range8", "import_id", "batch_number"]
    assert FEEDS["F26"].source_schema.names[13:15] == [
        "groundDefenseEquipmentType",
        "groundDefenseEquipmentId",
    ]


def test_plan_parts():
    sizes = {name: len(fields) for name, fields in PLAN_PARTS.items()}
    assert sizes == {
        "flight_head": 15, "flight_notes": 1, "flight_cmd": 3, "flight_task": 4, "flight_plan": 32,
    }


def test_snake_case():
    assert snake_case("messageTime") == "message_time"
    assert snake_case("xBandJammingAzimuthAngle") == "x_band_jamming_azimuth_angle"
    assert snake_case("slantRange8") == "slant_range8"
    assert snake_case("omnidirectionalDetectionQ1") == "omnidirectional_detection_q1"


def write(path, *lines):
    path.mkdir(parents=True)
    (path / "part.csv").write_text("\n".join(lines) + "\n")
    return str(path)


COMMAND = "a,b,c,d,e,f,g,h,i"


def test_batch_is_replaced_and_nulls_pass(spark, tmp_path, rows):
    spec = FEEDS["F07"]
    first = write(
        tmp_path / "first", COMMAND,
        'a1,10:00:00.123,,10:00:01,1,T,"x, ""y""",,2',
        "a2,,,,,,,,",
    )
    second = write(tmp_path / "second", COMMAND, "a3,23:59:59.999,,,5,T,c,d,")
    base = str(tmp_path / "out")
    load(spark, spec, first, base, import_id=1, batch_number="0007")
    load(spark, spec, first, base, import_id=1, batch_number="0008")
    load(spark, spec, second, base, import_id=2, batch_number="0007")
    stored = read_table(spark, spec.location(base), spec.target_schema)
    columns = "aircraft_id", "message_sequence_number", "command_id", "import_id", "batch_number"
    assert rows(stored, *columns) == [
        ("a1", 1, 'x, "y"', 1, "0008"),
        ("a2", None, None, 1, "0008"),
        ("a3", 5, "c", 2, "0007"),
    ]
    times = rows(stored.selectExpr("aircraft_id", "CAST(message_time AS STRING)"))
    assert times == [("a1", "10:00:00.123"), ("a2", None), ("a3", "23:59:59.999")]


def test_empty_reload_empties_the_batch(spark, tmp_path, rows):
    spec = FEEDS["F07"]
    full = write(tmp_path / "full", COMMAND, "a1,,,,1,,,,")
    empty = write(tmp_path / "empty", COMMAND)
    base = str(tmp_path / "out")
    for batch in ("b 1/x", "b2"):
        load(spark, spec, full, base, 1, batch)
    load(spark, spec, empty, base, 1, "b 1/x")
    stored = read_table(spark, spec.location(base), spec.target_schema)
    assert rows(stored, "batch_number") == [("b2",)]


@pytest.mark.parametrize("line", ["a1,10:00:00,,,1,T,c,d", "a1,10:00:00,,,1,T,c,d,2,extra"])
def test_rows_of_wrong_length_fail_even_when_few_columns_are_used(spark, tmp_path, line):
    path = write(tmp_path / "in", COMMAND, "a0,,,,1,,,,", line)
    df = csv_feed(spark, path, FEEDS["F07"].source_schema).select("aircraftId")
    with pytest.raises(Exception, match="(?i)malformed"):
        df.collect()


def test_bad_number_fails(spark, tmp_path):
    path = write(tmp_path / "in", COMMAND, "a0,,,,1,,,,", "a1,,,,word,T,c,d,2")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_feed(spark, path, FEEDS["F07"].source_schema).collect()


def test_bad_time_fails_and_keeps_the_old_batch(spark, tmp_path, rows):
    spec = FEEDS["F07"]
    base = str(tmp_path / "out")
    load(spark, spec, write(tmp_path / "good", COMMAND, "a1,10:00:00,,,1,,,,"), base, 1, "b")
    with pytest.raises(Exception, match="25:00:00"):
        load(spark, spec, write(tmp_path / "bad", COMMAND, "a2,25:00:00,,,1,,,,"), base, 1, "b")
    stored = read_table(spark, spec.location(base), spec.target_schema)
    assert rows(stored, "aircraft_id") == [("a1",)]


def test_sensor_feed_types(spark, tmp_path, rows):
    spec = FEEDS["F35"]
    path = write(tmp_path / "in", "a,b,c,d,e", "1,2,3,2024-05-01 10:00:00,61.5", "1,2,3,,")
    base = str(tmp_path / "out")
    load(spark, spec, path, base, import_id=9)
    load(spark, spec, path, base, import_id=9)
    stored = read_table(spark, spec.location(base), spec.target_schema)
    assert stored.count() == 4
    values = rows(stored.selectExpr("CAST(timestamp AS STRING)", "heart_rate", "import_id").distinct())
    assert values == [("2024-05-01 10:00:00", 61.5, 9), (None, None, 9)]


def test_later_element_of_a_file_wins(spark, tmp_path, rows):
    spec = FEEDS["F51"]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "people.json").write_text(
        '[{"personal_identifier":"p","name":"old"},{"personal_identifier":"q","name":"z"},'
        '{"personal_identifier":"p","name":"new","birthday":"1990-01-02"}]'
    )
    base = str(tmp_path / "out")
    load(spark, spec, str(folder), base, import_id=1)
    load(spark, spec, str(folder), base, import_id=2)
    stored = keyed_table(spec, base, 16).read(spark)
    assert rows(stored.selectExpr("personal_identifier", "name", "CAST(birthday AS STRING)", "import_id")) == [
        ("p", "new", "1990-01-02", 2), ("q", "z", None, 2),
    ]


def test_unknown_variant_and_missing_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "plans.json").write_text('[{"id":"r1"}]')
    with pytest.raises(ValueError, match="variant"):
        load(spark, FEEDS["F54"], str(folder), str(tmp_path / "out"), 1, variant="plan")
    path = write(tmp_path / "csv", COMMAND, "a1,,,,1,,,,")
    with pytest.raises(ValueError, match="batch number"):
        load(spark, FEEDS["F07"], path, str(tmp_path / "out"), 1)
