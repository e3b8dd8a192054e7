import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ferryline.feeds import FEEDS
from ferryline.plans import load_stream
from ferryline.plans.run import keyed_table
from ferryline.sinks import Counts, append, land_apart, read_table
from ferryline.sources import bad_messages, decode_arrays, records_of, with_reasons
from ferryline.streaming import file_stream

INNER = StructType([StructField("c", StringType())])
RECORD = StructType([StructField("a", LongType()), StructField("b", INNER)])

MESSAGES = "value STRING, timestamp TIMESTAMP, partition INT, offset BIGINT"


def send(spark, path, *values):
    at = datetime.datetime(2024, 5, 1)
    messages = [(v, at, 0, i) for i, v in enumerate(values)]
    spark.createDataFrame(messages, MESSAGES).coalesce(1).write.parquet(path)


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "n INT, value STRING")


def test_one_row_for_each_message(spark, rows):
    array = ArrayType(RECORD)
    messages = texts(spark, '[{"a":1},null]', '[{"a":"x"}]', None, "{}", '[{"a":1,"z":2},{"y":1}]', "[]")
    parsed = with_reasons(messages, array, keep=["n"])
    assert rows(bad_messages(parsed, keep=["n"]), "n", "reason") == [
        (1, "broken"), (2, "null or blank"), (3, "does not begin with ["), (4, "unknown fields: z, y"),
    ]
    assert rows(records_of(parsed, array, ["n"]), "n", "a") == [(0, 1)]
    nested = with_reasons(texts(spark, '{"b":{"c":"x"}}', '{"b":{"c":1,"d":2}}', '{"b":5}'), RECORD)
    assert rows(records_of(nested, RECORD), "b.c") == [("1",), ("x",)]
    assert [r.reason for r in bad_messages(nested).collect()] == ["broken"]


def test_texts_that_go_on_after_their_list(spark):
    messages = texts(spark, '[{"a":1}] x', '[{"a":1}],"_list":[{"a":2}]', '[{"a":1}]}', '[{"a":1},5]', '[{"b":{"c":"x"},"a":1.5}]')
    for strict in (True, False):
        parsed = with_reasons(messages, ArrayType(RECORD), strict=strict)
        assert [r.reason for r in bad_messages(parsed).collect()] == ["broken"] * 5
    for text in messages.collect():
        with pytest.raises(Exception, match="Malformed"):
            decode_arrays(texts(spark, text.value), RECORD).collect()


def test_white_space_around_messages(spark, rows):
    assert rows(decode_arrays(texts(spark, ' [{"a":1}]\r\n', '[ \n{"a":2}\t]\t '), RECORD), "a") == [(1,), (2,)]
    parsed = with_reasons(texts(spark, '{"a":1} x', '{"a":1}\n'), RECORD)
    assert [r.value for r in bad_messages(parsed).collect()] == ['{"a":1} x']


def test_envelopes_with_reasons(spark, rows):
    parsed = with_reasons(texts(spark, '{"data":[{"a":1},null]}', '{"code":1}', '{"data":null,"x":1}'), RECORD, field="data")
    assert rows(records_of(parsed, RECORD), "a") == [(1,)]
    assert [r.reason for r in bad_messages(parsed).collect()] == ["no field data"]


def test_columns_that_are_called_like_ours(spark, rows):
    messages = texts(spark, '{"reason":1,"_broken":null}', "x").withColumn("reason", F.lit("mine"))
    schema = StructType.fromDDL("reason INT")
    parsed = with_reasons(messages, schema, keep=["reason"], strict=False)
    assert rows(records_of(parsed, schema), "reason") == [(1,)]
    assert bad_messages(parsed, keep=["reason"]).columns == ["value", "reason"]


def test_a_text_is_parsed_once(spark):
    """Looking for unknown fields is one parse of its own; nothing is parsed before a list is taken apart."""
    plan = decode_arrays(texts(spark, "[]").repartition(2), RECORD)._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("from_json") == 2


def test_both_sides_from_one_decode(spark, tmp_path, rows):
    calls = spark.sparkContext.accumulator(0)

    def counted(value):
        calls.add(1)
        return value

    said = F.udf(counted, "string")
    messages = texts(spark, '{"a":1}', "{", '{"a":2}', None).select("n", said("value").alias("value"))
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    parsed = with_reasons(messages, RECORD, keep=["n"])
    counts = land_apart(parsed, RECORD, lambda d: append(d, good), lambda d: append(d, bad), ["n"])
    assert counts == Counts(4, 2) and calls.value == 4
    assert rows(read_table(spark, good), "n", "a") == [(0, 1), (2, 2)]
    assert rows(read_table(spark, bad), "n", "reason") == [(1, "broken"), (3, "null or blank")]


def test_nothing_to_land(spark, tmp_path):
    parsed = with_reasons(texts(spark, "x").where("n > 0"), RECORD)
    base = str(tmp_path)
    counts = land_apart(
        parsed, RECORD, lambda d: append(d, f"{base}/a"), lambda d: append(d, f"{base}/b")
    )
    assert counts == Counts(0, 0)
    assert read_table(spark, f"{base}/a", RECORD).count() == 0


@pytest.mark.parametrize("until_end", [False, True])
def test_a_stream_goes_on_past_bad_messages(spark, tmp_path, rows, until_end):
    spec, source, base = FEEDS["F49"], str(tmp_path / "in"), str(tmp_path / "out")
    first = '{"sortie_id":"1","sortie_number":"a"}'
    send(spark, source, first, "{", '{"pilotId":1}', '{"sortie_number":"END_1"}')
    stream = file_stream(spark, source, MESSAGES)
    query, signal = load_stream(stream, spec, base, f"{base}/check", bad="apart", until_end=until_end)
    if until_end:
        query.processAllAvailable()
        query.stop()
        assert signal.seen
    else:
        query.awaitTermination()
    assert rows(keyed_table(spec, base, 16).read(spark), "sortie_id") == [("1",)]
    apart = read_table(spark, f"{spec.location(base)}_rejected")
    assert rows(apart, "_offset", "reason") == [(1, "broken"), (2, "unknown fields: pilotId")]


def test_a_repeated_batch_sets_its_messages_apart_once(spark, tmp_path, rows):
    spec, source, base = FEEDS["F44"], str(tmp_path / "in"), str(tmp_path / "out")
    send(spark, source, '{"pilot_id":7}', "[]")
    calls = []

    def lost_once(batch):
        calls.append(batch)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return batch

    for _ in range(2):
        stream = file_stream(spark, source, MESSAGES)
        query, _ = load_stream(stream, spec, base, f"{base}/check", 5, bad="apart", steps=[lost_once])
        try:
            query.awaitTermination()
        except Exception as error:
            assert "lost" in str(error)
    assert len(calls) == 2
    assert rows(read_table(spark, spec.location(base)), "pilot_id") == [(7,)]
    assert read_table(spark, f"{spec.location(base)}_rejected").count() == 1


def test_what_cannot_be_set_apart(spark, tmp_path):
    send(spark, str(tmp_path / "in"), "x")
    stream = file_stream(spark, str(tmp_path / "in"), MESSAGES)
    for code, bad in (("F55", "apart"), ("F44", "ignore")):
        with pytest.raises(ValueError):
            load_stream(stream, FEEDS[code], str(tmp_path), str(tmp_path / "c"), bad=bad)
