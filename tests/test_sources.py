import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from ferryline.sources import (
    TableRef,
    decode_arrays,
    decode_changes,
    decode_envelopes,
    decode_objects,
    decode_xml,
    jdbc_options,
    json_array_files,
    json_document_files,
    kafka_options,
    point_lookup,
    rejected,
)
from ferryline.sources.changelog import DELETED

RECORD = StructType(
    [StructField("a", LongType()), StructField("b", DoubleType()), StructField("c", StringType())]
)


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def test_objects(spark, rows):
    df = decode_objects(texts(spark, '{"a":1,"b":NaN,"c":"x\ty"}', "{}"), RECORD)
    got = rows(df)
    assert got[1] == (None, None, None)
    assert got[0][0] == 1 and got[0][1] != got[0][1] and got[0][2] == "x\ty"


def test_bad_message_fails(spark):
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        decode_objects(texts(spark, '{"a":'), RECORD).collect()


def test_arrays_drop_nulls_and_empty_lists(spark, rows):
    df = decode_arrays(texts(spark, '[{"a":1},null,{"a":2}]', "[]", "[null]"), RECORD)
    assert rows(df, "a") == [(1,), (2,)]


def test_envelopes(spark, rows):
    bodies = texts(spark, '{"code":0,"data":[{"a":1},{"a":2}]}', '{"data":[]}', '{"data":null}')
    assert rows(decode_envelopes(bodies, RECORD, "data"), "a") == [(1,), (2,)]
    results = texts(spark, '{"result":[{"a":3}]}')
    assert rows(decode_envelopes(results, RECORD, "result"), "a") == [(3,)]


def test_first_xml_document(spark, rows):
    body = '[{"xml":"<r k=\\"7\\"><h><t>x</t></h><c><n>1</n></c><c><n>2</n></c></r>"},{"xml":"<r/>"}]'
    schema = StructType.fromDDL("_k INT, h STRUCT<t: STRING>, c ARRAY<STRUCT<n: INT>>")
    got = rows(decode_xml(texts(spark, body), schema).selectExpr("_k", "h.t", "c.n"))
    assert got == [(7, "x", [1, 2])]


def test_changes(spark, rows):
    messages = spark.createDataFrame(
        [
            (1, '{"op":"c","before":null,"after":{"a":1,"c":"x"}}'),
            (2, '{"op":"u","before":{"a":1},"after":{"a":1,"c":"y"}}'),
            (3, '{"op":"d","before":{"a":1,"c":"y"},"after":null}'),
        ],
        "seq INT, value STRING",
    )
    got = rows(decode_changes(messages, RECORD, "value", ["seq"]), "seq", DELETED, "a", "c")
    assert got == [(1, False, 1, "x"), (2, False, 1, "y"), (3, True, 1, "y")]


def test_unknown_change_fails(spark):
    messages = spark.createDataFrame([(1, '{"op":"t","after":{"a":1}}')], "seq INT, value STRING")
    with pytest.raises(Exception, match="unknown change operation"):
        decode_changes(messages, RECORD, "value", ["seq"]).collect()


def test_json_files(spark, tmp_path, rows):
    (tmp_path / "one.json").write_text('[{"a":1,"b":NaN},\n {"a":2}]')
    (tmp_path / "two.json").write_text("[]")
    assert rows(json_array_files(spark, str(tmp_path), RECORD), "a") == [(1,), (2,)]
    (tmp_path / "doc").mkdir()
    (tmp_path / "doc" / "d.json").write_text('{"a":5,\n"c":"x"}')
    assert rows(json_document_files(spark, str(tmp_path / "doc"), RECORD), "a", "c") == [(5, "x")]
    (tmp_path / "bad.json").write_text('[{"a":')
    with pytest.raises(Exception, match="(?i)malformed"):
        json_array_files(spark, str(tmp_path / "bad.json"), RECORD).collect()


def test_from_json_runs_once_per_message(spark):
    df = decode_objects(texts(spark, '{"a":1}').repartition(2), RECORD)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_point_lookup(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    assert point_lookup(df, "id", 4)["v"] == 8
    with pytest.raises(LookupError):
        point_lookup(df, "id", 99)


def test_table_schema_is_found_when_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert TableRef("parquet", path).read(spark).columns == ["id"]
    spark.range(3).selectExpr("id AS other", "'x' AS text").write.mode("overwrite").parquet(path)
    assert TableRef("parquet", path).read(spark).columns == ["other", "text"]
    with pytest.raises(ValueError):
        TableRef("file", path).read(spark)


def test_reader_options():
    options = kafka_options("h:1", ["a", "b"], now_ms=50_000)
    assert options["startingTimestamp"] == "40000" and options["subscribe"] == "a,b"
    jdbc = jdbc_options("jdbc:x", "t", "id", (0, 100), 8)
    assert (jdbc["partitionColumn"], jdbc["upperBound"], jdbc["numPartitions"]) == ("id", "100", "8")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id")


BAD_OBJECTS = {
    None: "null or blank", " ": "null or blank", "[]": "does not begin", "5": "does not begin",
    '{"a":1,"pilotId":2}': "unknown fields: pilotId",
}
BAD_ARRAYS = {
    None: "null or blank", "": "null or blank", '{"a":1}': "does not begin",
    '[{"a":1},{"z":2}]': "unknown fields: z",
}


@pytest.mark.parametrize("decode,bad", [(decode_objects, BAD_OBJECTS), (decode_arrays, BAD_ARRAYS)])
def test_bad_messages_fail_or_are_left_out(spark, rows, decode, bad):
    for text, reason in bad.items():
        with pytest.raises(Exception, match=reason):
            decode(texts(spark, text), RECORD).collect()
    array = decode is decode_arrays
    good = '[{"a":1}]' if array else '{"a":1}'
    broken = '[{"a":' if array else '{"a":'
    messages = texts(spark, good, broken, *bad)
    assert rows(decode(messages, RECORD, bad="skip"), "a") == [(1,)]
    kind = ArrayType(RECORD) if array else RECORD
    left = {r.value: r.reason for r in rejected(messages, kind).collect()}
    assert set(left) == {broken, *bad} and left[broken] == "broken"
    assert all(reason in left[text] for text, reason in bad.items())
    with pytest.raises(ValueError):
        decode(messages, RECORD, bad="ignore")


def test_unknown_fields_can_be_allowed(spark, rows):
    assert rows(decode_objects(texts(spark, '{"a":1,"x":2}'), RECORD, strict=False), "a") == [(1,)]


def test_bodies_without_their_field_fail(spark, rows):
    for body in ('{"code":401}', "", None, "[]"):
        with pytest.raises(Exception, match="no field data|null or blank|does not begin"):
            decode_envelopes(texts(spark, body), RECORD, "data").collect()
    bodies = texts(spark, '{"code":401}', '{"code":0,"data":[{"a":1}]}', None)
    assert rows(decode_envelopes(bodies, RECORD, "data", bad="skip"), "a") == [(1,)]


def test_tombstones_are_no_changes(spark, rows):
    messages = spark.createDataFrame(
        [(1, '{"op":"d","before":{"a":1},"after":null}'), (2, None)], "seq INT, value STRING"
    )
    assert rows(decode_changes(messages, RECORD, "value", ["seq"]), "seq", DELETED) == [(1, True)]
    nameless = spark.createDataFrame([(1, '{"after":{"a":1}}')], "seq INT, value STRING")
    with pytest.raises(Exception, match="unknown change operation: none"):
        decode_changes(nameless, RECORD, "value", ["seq"]).collect()


def test_lookup_of_a_repeated_key_fails(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id INT, v STRING")
    with pytest.raises(LookupError, match="several rows"):
        point_lookup(df, "id", 1)


def test_json_arrays_by_line(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text('[\n{"a":1,"c":"x],["},\n {"a":2},\nnull,\n{"a":3}\n]\n')
    (tmp_path / "b.json").write_text('[{"a":4}\n,{"a":5}]')
    (tmp_path / "c.json").write_text("[]")
    df = json_array_files(spark, str(tmp_path), RECORD, by_line=True)
    assert rows(df, "a") == [(1,), (2,), (3,), (4,), (5,)]
    assert df.where("a = 1").first().c == "x],["
    (tmp_path / "d.json").write_text('[{"a":1},{"a":\n2}]')
    with pytest.raises(Exception, match="(?i)malformed"):
        json_array_files(spark, str(tmp_path / "d.json"), RECORD, by_line=True).collect()


def test_kafka_batches_are_bounded():
    assert int(kafka_options("h:1", ["a"], now_ms=1)["maxOffsetsPerTrigger"]) > 0
