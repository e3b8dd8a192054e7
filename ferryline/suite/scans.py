"""Scans and decoders."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ferryline.functions import epoch_ms, epoch_ms_to_local, has_prefix
from ferryline.operators import key_equals, stamp
from ferryline.plans import flight_plans
from ferryline.session import new_dir
from ferryline.sinks.apart import land_apart
from ferryline.sinks.append import append, read_table
from ferryline.sinks.publish import encode_messages
from ferryline.sources import (
    TableRef,
    csv_feed,
    decode_arrays,
    decode_envelopes,
    decode_objects,
    decode_xml,
    json_array_files,
    json_array_splits,
    json_document_files,
    point_lookup,
    with_reasons,
)
from ferryline.suite.tables import blocks, table, write_texts


def csv_round_trip(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = new_dir(spark, "csv")
    other_names = [f"field{i}" for i in range(len(customer.columns))]
    customer.toDF(*other_names).write.option("header", True).csv(path)
    return csv_feed(spark, path, customer.schema)


def json_arrays(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    packed = blocks(part, "p_partkey", 5000).select("block", F.to_json("records").alias("value"))
    path = write_texts(packed, new_dir(spark, "json-array"))
    return json_array_files(spark, path, part.schema).select(*part.columns)


def json_array_layouts(spark, sf_dir):
    """Pretty-printed arrays and arrays on a single line, read in splits.

    Notes hold brackets, braces, quotes and backslashes; every seventh element is null.
    """
    customer = table(spark, sf_dir, "customer")
    odd = F.concat(F.lit('}], [{"x": "'), F.col("c_mktsegment"), F.lit('\\\\" \n\t\\'))
    nested = F.struct("c_acctbal", F.array("c_nationkey").alias("nations"), odd.alias("note"))
    records = customer.select("c_custkey", "c_name", nested.alias("more"))
    base = new_dir(spark, "json-layouts")
    for name, options, between, rest in (("pretty", {"pretty": "true"}, ",\n", 0), ("line", {}, ",", 1)):
        text = F.to_json(F.struct(*records.columns), options)
        text = F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("null, "), text)).otherwise(text)
        rows = records.where(F.col("c_custkey") % 2 == rest).select("c_custkey", text.alias("text"))
        packed = blocks(rows, "c_custkey", 20_000)
        whole = F.array_join(F.transform("records", lambda r: r["text"]), between)
        values = packed.select("block", F.concat(F.lit("["), whole, F.lit(f"{between[1:]}]")).alias("value"))
        write_texts(values, f"{base}/{name}")
    pretty, line = (json_array_splits(spark, f"{base}/{n}", records.schema) for n in ("pretty", "line"))
    found = pretty.unionByName(line)
    return found.select(
        "c_custkey", "c_name", "more.c_acctbal", F.col("more.nations")[0].alias("c_nationkey"), "more.note"
    )


JSON_LAYOUTS_SQL = """
    SELECT c_custkey, c_name, c_acctbal, c_nationkey,
           '}], [{"x": "' || c_mktsegment || chr(92) || chr(92) || '" ' || chr(10) || chr(9) || chr(92) AS note
    FROM customer
"""


def json_documents(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    packed = blocks(supplier, "s_suppkey", 1000, name="suppliers")
    documents = packed.select(
        "block", F.to_json(F.struct(F.col("block").alias("id"), "suppliers")).alias("value")
    )
    path = write_texts(documents, new_dir(spark, "json-doc"))
    schema = StructType(
        [StructField("id", LongType()), StructField("suppliers", ArrayType(supplier.schema))]
    )
    read = json_document_files(spark, path, schema).select("id", "suppliers")
    return read.select("id", F.inline("suppliers"))


def object_messages(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    schema = StructType([StructField("k", LongType())])
    return decode_objects(events, schema, value="props", keep=["event_id"])


EVENT = ["event_id", "user_id", "event_type", "value"]


def array_messages(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(*EVENT)
    with_null = F.array_append("records", F.lit(None))
    messages = blocks(events, "event_id", 100).select(F.to_json(with_null).alias("value"))
    return decode_arrays(messages, events.schema)


def dead_letters(spark, sf_dir):
    """Lists of records of which three in ten are bad: cut off, with an unknown field, or null."""
    events = table(spark, sf_dir, "events").select(*EVENT)
    text, kind = F.to_json("records"), F.col("block") % 10
    sent = (
        F.when(kind == 3, F.substring(text, 1, 40))
        .when(kind == 5, F.regexp_replace(text, '"user_id"', '"userId"'))
        .when(kind != 7, text)
    )
    messages = blocks(events, "event_id", 100).select("block", sent.alias("value"))
    schema, base = ArrayType(events.schema), new_dir(spark, "dead-letters")
    parsed = with_reasons(messages, schema, keep=["block"])
    land_apart(
        parsed,
        schema,
        lambda good: append(good, f"{base}/events"),
        lambda bad: append(bad, f"{base}/events_rejected"),
        ["block"],
    )
    good, bad = (read_table(spark, f"{base}/{name}") for name in ("events", "events_rejected"))
    return good.select(*EVENT, F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select(F.col("block").alias("event_id"), "reason"), allowMissingColumns=True
    )


DEAD_LETTERS_SQL = """
    SELECT event_id, user_id, event_type, value, CAST(NULL AS VARCHAR) AS reason
    FROM events WHERE event_id // 100 % 10 NOT IN (3, 5, 7)
    UNION ALL
    SELECT DISTINCT event_id // 100, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE),
           CASE event_id // 100 % 10 WHEN 3 THEN 'broken' WHEN 5 THEN 'unknown fields: userId'
                ELSE 'null or blank' END
    FROM events WHERE event_id // 100 % 10 IN (3, 5, 7)
"""


def envelopes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    bodies = blocks(orders, "o_orderkey", 50, name="data").select(
        F.to_json(F.struct(F.lit(0).alias("code"), "data")).alias("value")
    )
    return decode_envelopes(bodies, orders.schema, "data")


def xml_documents(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    document = F.concat(
        F.lit('<plan key="'), F.col("c_custkey").cast("string"),
        F.lit('"><head><name>'), F.col("c_name"),
        F.lit("</name><nation>"), F.col("c_nationkey").cast("string"),
        F.lit("</nation></head><note>a</note><note>b</note></plan>"),
    )
    element = F.struct(document.alias("xml"), F.col("c_mktsegment").alias("segment"))
    bodies = customer.select(F.to_json(F.array(element)).alias("value"))
    schema = "_key BIGINT, head STRUCT<name: STRING, nation: INT>, note ARRAY<STRING>"
    carry = StructType([StructField("segment", StringType())])
    decoded = decode_xml(bodies, StructType.fromDDL(schema), carry=carry)
    return decoded.select(
        F.col("_key").alias("c_custkey"),
        F.col("head.name").alias("c_name"),
        F.col("head.nation").alias("c_nationkey"),
        "segment",
        F.size("note").alias("notes"),
    )


def plan_documents(spark, sf_dir):
    """New order dates to codes to XML documents: landed list, code and document bodies."""
    orders = table(spark, sf_dir, "orders")
    dates = orders.groupBy(F.to_date("o_orderdate").alias("flight_date")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("top")
    )
    loaded = dates.where(F.col("flight_date") < F.lit("1998-01-01").cast("date"))
    codes = dates.select(
        "flight_date", F.concat(F.lit("code-"), F.col("flight_date").cast("string")).alias("code")
    )
    document = F.concat(
        F.lit("<r><title>"), F.col("top").cast("string"), F.lit("</title><n>"),
        F.col("n").cast("string"), F.lit("</n></r>"),
    )
    element = F.struct(
        document.alias("xml"),
        F.date_format("flight_date", "yyyy-MM-dd 08:30:00").alias("flight_date_time"),
    )
    bodies = dates.select(
        F.concat(F.lit("code-"), F.col("flight_date").cast("string")).alias("code"),
        F.to_json(F.array(element)).alias("value"),
    )
    schema = StructType.fromDDL("title STRING, n BIGINT")
    return flight_plans.documents_from_payloads(dates, loaded, codes, bodies, schema)


def runtime_schema(spark, sf_dir):
    return TableRef("parquet", f"{sf_dir}/supplier.parquet").read(spark)


def lookup(spark, sf_dir):
    """One parent by key, its key values stamped on its children."""
    parent = point_lookup(table(spark, sf_dir, "customer"), "c_name", "Customer#000000001")
    children = key_equals(table(spark, sf_dir, "orders"), "o_custkey", parent["c_custkey"])
    return stamp(children.select("o_orderkey", "o_totalprice"), c_name=parent["c_name"])


def encode(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return decode_objects(encode_messages(orders), orders.schema)


def prefix(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", has_prefix(F.col("p_name"), "red").alias("is_red"))


def epoch_round_trip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", epoch_ms(F.col("ts")).alias("ms")).withColumn(
        "local", epoch_ms_to_local(F.col("ms"), "Asia/Shanghai")
    )


QUERIES = {
    "q01_csv_feed": (csv_round_trip, "SELECT * FROM customer"),
    "q02_json_array_file": (json_arrays, "SELECT * FROM part"),
    "q02b_json_array_splits": (json_array_layouts, JSON_LAYOUTS_SQL),
    "q03_json_doc_file": (
        json_documents,
        "SELECT s_suppkey // 1000 AS id, * FROM supplier",
    ),
    "q04_json_message": (
        object_messages,
        "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    ),
    "q05_json_array_message": (
        array_messages,
        "SELECT event_id, user_id, event_type, value FROM events",
    ),
    "q05b_dead_letters": (dead_letters, DEAD_LETTERS_SQL),
    "q06_envelope": (envelopes, "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"),
    "q07_xml_payload": (
        xml_documents,
        "SELECT c_custkey, c_name, c_nationkey, c_mktsegment AS segment, "
        "CAST(2 AS INTEGER) AS notes FROM customer",
    ),
    "q07b_plan_documents": (
        plan_documents,
        """
        SELECT CAST(o_orderdate AS DATE) AS flight_date,
               'code-' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS id,
               CAST(o_orderdate AS DATE) + INTERVAL 510 MINUTE AS flight_date_time,
               CAST(max(o_orderkey) AS VARCHAR) AS title, count(*) AS n
        FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1998-01-01' GROUP BY 1, 2, 3
        """,
    ),
    "q09_runtime_schema_scan": (runtime_schema, "SELECT * FROM supplier"),
    "q10_point_lookup": (
        lookup,
        """
        SELECT o_orderkey, o_totalprice, c_name FROM orders
        JOIN customer ON o_custkey = c_custkey WHERE c_name = 'Customer#000000001'
        """,
    ),
    "q19b_prefix": (
        prefix,
        "SELECT p_partkey, starts_with(p_name, 'red') AS is_red FROM part",
    ),
    "q27b_epoch_to_local": (
        epoch_round_trip,
        """
        SELECT event_id, epoch_us(ts) // 1000 AS ms,
               make_timestamp(epoch_us(ts) // 1000 * 1000) + INTERVAL 8 HOUR AS local FROM events
        """,
    ),
    "q37_json_encode": (encode, "SELECT * FROM orders"),
}
