import datetime

import pytest

from ferryline.feeds import FEEDS
from ferryline.plans import load_stream
from ferryline.plans.run import keyed_table
from ferryline.functions import camel_case
from ferryline.sinks import append_once, encode_messages, end_message, jdbc_types, read_table
from ferryline.streaming import (
    EndSignal,
    file_stream,
    land,
    load_name,
    run_trigger,
    run_until_end,
    with_event_time,
)

MESSAGES = "value STRING, timestamp TIMESTAMP, partition INT, offset BIGINT"


def send(spark, path, *values, start=0, day=1, partition=0):
    at = datetime.datetime(2024, 5, day)
    rows = [(v, at, partition, start + i) for i, v in enumerate(values)]
    spark.createDataFrame(rows, MESSAGES).coalesce(1).write.mode("append").parquet(path)


def test_restart_continues_and_a_failed_batch_is_repeated(spark, tmp_path, rows):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    send(spark, source, "a", "b")
    calls = []

    def failing(batch, batch_id):
        append_once(batch.select("value"), out, batch_id)
        calls.append(batch_id)
        raise RuntimeError("lost after the write")

    query = land(file_stream(spark, source, MESSAGES), failing, check)
    with pytest.raises(Exception, match="lost after the write"):
        query.awaitTermination()

    def write(batch, batch_id):
        append_once(batch.select("value"), out, batch_id)
        calls.append(batch_id)

    for values in ((), ("c",), ()):
        if values:
            send(spark, source, *values, start=2)
        land(file_stream(spark, source, MESSAGES), write, check).awaitTermination()
    assert rows(read_table(spark, out), "value") == [("a",), ("b",), ("c",)]
    assert calls == [0, 0, 1]


def test_two_streams_into_one_table(spark, tmp_path):
    spec = FEEDS["F47"]
    base = str(tmp_path / "out")
    for name in ("one", "two"):
        send(spark, str(tmp_path / name), f'{{"task_id":1,"illuminance":{len(name)}}}')
        for _ in range(2):
            query, _ = load_stream(
                file_stream(spark, str(tmp_path / name), MESSAGES), spec, base,
                str(tmp_path / f"check-{name}"), 5,
            )
            query.awaitTermination()
    assert read_table(spark, spec.location(base), spec.target_schema).count() == 2


def test_load_names_belong_to_a_stream(spark):
    with pytest.raises(RuntimeError):
        load_name(spark.range(1), 0)


def test_keyed_feed_over_two_runs(spark, tmp_path, rows):
    spec = FEEDS["F48"]
    source, base, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for run, values in enumerate((
        ('{"id":"1","batch_number":"a"}', '{"id":"2","batch_number":"b"}', '{"id":"1","batch_number":"c"}'),
        ('{"id":"2","batch_number":null}', '{"id":"3","batch_number":"d"}'),
    )):
        send(spark, source, *values, start=10 * run)
        query, signal = load_stream(file_stream(spark, source, MESSAGES), spec, base, check, 5)
        assert signal is None
        query.awaitTermination()
    stored = keyed_table(spec, base, 16).read(spark)
    assert rows(stored) == [("1", "c", 5), ("2", None, 5), ("3", "d", 5)]


def test_streams_may_have_no_import_id(spark, tmp_path, rows):
    spec = FEEDS["F47"]
    source, base, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    send(spark, source, '{"task_id":1,"device_id":2,"timestamp":"2024-05-01T10:00:00","illuminance":NaN}')
    query, _ = load_stream(file_stream(spark, source, MESSAGES), spec, base, check)
    query.awaitTermination()
    got = read_table(spark, spec.location(base), spec.target_schema).first()
    assert got["import_id"] is None and got["illuminance"] != got["illuminance"]


def test_end_row_stops_a_polled_stream_after_all_rows(spark, tmp_path, rows):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    send(spark, source, "END_1")
    send(spark, source, "a")
    signal = EndSignal(
        lambda b, i: append_once(b.select("value"), out, i), "value", "END_"
    )
    stream = file_stream(spark, source, MESSAGES, files_per_batch=1)
    query = land(stream, signal, check, "SCHEDULED", "0 seconds")
    run_until_end(query, signal, grace_seconds=0.1)
    assert signal.seen and not query.isActive
    assert rows(read_table(spark, out), "value") == [("a",)]


def test_triggers_and_event_time(spark, tmp_path):
    assert run_trigger("AT_ONCE") == {"availableNow": True}
    assert run_trigger("SCHEDULED", "60 minutes") == {"processingTime": "60 minutes"}
    with pytest.raises(ValueError):
        run_trigger("SOMETIMES")
    spark.range(1).selectExpr("TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts").write.parquet(str(tmp_path / "t"))
    stream = with_event_time(file_stream(spark, str(tmp_path / "t"), "ts TIMESTAMP_NTZ"), "ts")
    assert "EventTimeWatermark" in stream._jdf.queryExecution().analyzed().toString()


def test_time_orders_versions_over_partitions(spark, tmp_path, rows):
    spec = FEEDS["F48"]
    source, base, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    send(spark, source, '{"id":"1","batch_number":"new"}', start=900, day=20, partition=0)
    send(spark, source, '{"id":"1","batch_number":"old"}', start=1, day=2, partition=3)
    query, _ = load_stream(file_stream(spark, source, MESSAGES), spec, base, check, 5)
    query.awaitTermination()
    assert rows(keyed_table(spec, base, 16).read(spark)) == [("1", "new", 5)]


def test_an_older_message_in_a_later_run_does_nothing(spark, tmp_path, rows):
    spec = FEEDS["F48"]
    source, base, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for day, value in ((20, "new"), (2, "old"), (21, "last"), (20, "new")):
        send(spark, source, f'{{"id":"1","batch_number":"{value}"}}', day=day)
        query, _ = load_stream(file_stream(spark, source, MESSAGES), spec, base, check, 5)
        query.awaitTermination()
    assert rows(keyed_table(spec, base, 16).read(spark)) == [("1", "last", 5)]


def test_end_rows_have_no_key(spark, tmp_path, rows):
    """As a producer sends them: dropped by a run-once feed, set apart by a scheduled one."""
    spec = FEEDS["F49"]
    source = str(tmp_path / "in")
    (end,) = end_message(spark, spec, 1).collect()
    assert end.value == '{"sortie_number":"END_1"}'
    send(spark, source, '{"sortie_id":"1","sortie_number":"n"}', end.value)
    stream = file_stream(spark, source, MESSAGES)
    once = str(tmp_path / "once")
    query, signal = load_stream(stream, spec, once, f"{once}/check")
    query.awaitTermination()
    assert signal is None
    assert rows(keyed_table(spec, once, 16).read(spark), "sortie_id") == [("1",)]
    polled = str(tmp_path / "polled")
    query, _ = load_stream(stream, spec, polled, f"{polled}/check", mode="SCHEDULED", interval="0 seconds")
    query.processAllAvailable()
    query.stop()
    assert rows(keyed_table(spec, polled, 16).read(spark), "sortie_id") == [("1",)]
    apart = read_table(spark, f"{spec.location(polled)}_keyless")
    assert rows(apart, "sortie_number") == [("END_1",)]


def test_end_is_remembered_by_a_restarted_stream(spark, tmp_path):
    spec = FEEDS["F49"]
    source, base, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    send(spark, source, '{"sortie_number":"END_1"}')
    for _ in range(2):
        stream = file_stream(spark, source, MESSAGES)
        query, signal = load_stream(stream, spec, base, check, until_end=True)
        run_until_end(query, signal, grace_seconds=0.1)
        assert not query.isActive


def test_names_on_the_wire(spark, tmp_path, rows):
    sent = {
        "snake": ('{"pilot_id":7,"task_id":8,"sampling_rate":5}', FEEDS["F44"]),
        "camel": ('{"pilotId":7,"taskId":8,"samplingRate":5}', FEEDS["F44"].on_wire(camel_case)),
        "mixed": ('{"pid":7,"task_id":8,"sampling_rate":5}', FEEDS["F44"].on_wire({"pilot_id": "pid"})),
    }
    for name, (value, spec) in sent.items():
        send(spark, str(tmp_path / name), value)
        stream = file_stream(spark, str(tmp_path / name), MESSAGES)
        base = str(tmp_path / f"{name}-out")
        query, _ = load_stream(stream, spec, base, f"{base}/check", 5)
        query.awaitTermination()
        stored = read_table(spark, spec.location(base), spec.target_schema)
        assert rows(stored, "pilot_id", "task_id", "sampling_rate") == [(7, 8, 5.0)]
    stream = file_stream(spark, str(tmp_path / "camel"), MESSAGES)
    query, _ = load_stream(stream, FEEDS["F44"], str(tmp_path / "bad"), str(tmp_path / "bad-check"))
    with pytest.raises(Exception, match="unknown fields"):
        query.awaitTermination()


def test_times_of_day_leave_as_text(spark, rows):
    df = spark.sql("SELECT 1 AS a, TIME'09:05:03.120' AS at")
    assert rows(encode_messages(df, "a")) == [("1", '{"a":1,"at":"09:05:03.120"}')]
    types = {f.name: f.dataType.simpleString() for f in jdbc_types(df).schema}
    assert types == {"a": "int", "at": "string"}
    assert jdbc_types(df).first()["at"] == "09:05:03.120"


@pytest.mark.parametrize("spec", FEEDS.values(), ids=lambda s: s.code)
def test_every_target_has_database_types(spark, spec):
    """Each stored type is one that a JDBC writer knows."""
    known = {"string", "bigint", "int", "smallint", "tinyint", "double", "date", "timestamp_ntz"}
    empty = spark.createDataFrame([], spec.target_schema)
    for field in jdbc_types(empty).schema:
        kind = field.dataType.simpleString()
        assert kind in known or kind.startswith("decimal"), (field.name, kind)
