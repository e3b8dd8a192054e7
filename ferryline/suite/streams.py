"""Streams: landing files, and every message feed through its stream plan."""

from __future__ import annotations

import itertools
import time

from pyspark.sql import functions as F

from ferryline.feeds import feed
from ferryline.plans import load_stream
from ferryline.plans.run import keyed_table
from ferryline.session import new_dir
from ferryline.sinks import (
    append_once,
    compact_loads,
    encode_messages,
    end_message,
    read_landed,
    read_table,
)
from ferryline.streaming import (
    EndSignal,
    close_after_end,
    file_stream,
    land,
    load_name,
    once,
    run_until_end,
    with_event_time,
)
from ferryline.suite.derived import records, sql_columns
from ferryline.suite.feeds import IMPORT_ID, PLAN_SQL, plan_documents, plan_rows
from ferryline.suite.tables import blocks, spread, table

MESSAGES = "value STRING, timestamp TIMESTAMP, partition INT, offset BIGINT"


def landed(spark, sf_dir):
    """The file of ``events`` as a stream, with event time, into a table."""
    events = table(spark, sf_dir, "events")
    base = new_dir(spark, "land")
    stream = file_stream(spark, f"{sf_dir}/events*.parquet", events.schema)
    stream = with_event_time(stream, "ts").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    query = land(
        stream, lambda rows, batch_id: append_once(rows, f"{base}/out", batch_id), f"{base}/check"
    )
    query.awaitTermination()
    return read_table(spark, f"{base}/out", events.schema)


def stopped(spark, sf_dir):
    """A polled stream that ends by itself after its end row; the end row is not stored."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    base = new_dir(spark, "stop")
    control = spark.createDataFrame([(-1, "END_1")], "event_id BIGINT, event_type STRING")
    events.unionByName(control).write.parquet(f"{base}/in")
    signal = EndSignal(
        lambda rows, batch_id: append_once(rows, f"{base}/out", batch_id), "event_type", "END_"
    )
    stream = file_stream(spark, f"{base}/in", events.schema)
    query = land(stream, signal, f"{base}/check", "SCHEDULED", "0 seconds")
    run_until_end(query, signal, grace_seconds=1)
    return read_table(spark, f"{base}/out", events.schema)


def closed_by_key(spark, sf_dir):
    """Events by type; two types have an end row and close, each by its own timer."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    base = new_dir(spark, "close")
    ends = spark.createDataFrame([(-1, "error"), (-1, "view")], events.schema)
    events.unionByName(ends).write.parquet(f"{base}/in")
    stream = file_stream(spark, f"{base}/in", events.schema)
    closing = close_after_end(stream, "event_type", F.col("event_id") == -1, grace_seconds=1)
    query = land(
        closing, lambda rows, batch_id: append_once(rows, f"{base}/out", batch_id),
        f"{base}/check", "SCHEDULED", "0 seconds",
    )
    closed = F.count_if(F.col("state") == "closed")
    last = time.monotonic() + 300
    try:
        # Timers fire after the micro-batch that takes the rows, so an output of it is there.
        while not query.awaitTermination(1):
            if query.lastProgress and query.lastProgress.batchId > 1:
                found = read_table(spark, f"{base}/out", closing.schema)
                if found.agg(closed).first()[0] == 2 or time.monotonic() > last:
                    break
    finally:
        query.stop()
    counts = read_table(spark, f"{base}/out", closing.schema).groupBy("event_type")
    return counts.agg(F.count_if(F.col("state") == "open").alias("n_rows"), (closed > 0).alias("closed"))


def repeated(spark, sf_dir):
    """Every event, then a third of them again, then a fifth; each is stored once."""
    events = spread(spark, sf_dir, "events")
    base = new_dir(spark, "once")
    for part in (events, events.where("event_id % 3 = 0"), events.where("event_id % 5 = 0")):
        part.write.mode("append").parquet(f"{base}/in")
        stream = once(file_stream(spark, f"{base}/in", events.schema), ["event_id"], "ts", "10 minutes")
        stream = stream.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        land(
            stream, lambda rows, batch_id: append_once(rows, f"{base}/out", batch_id), f"{base}/check"
        ).awaitTermination()
    return read_table(spark, f"{base}/out", events.schema)


def compacted(spark, sf_dir):
    """Events landed in many micro-batches, compacted twice on the way, the last one repeated."""
    events = spread(spark, sf_dir, "events")
    base = new_dir(spark, "compact")
    out = f"{base}/out"
    seen = {}

    def write(rows, batch_id):
        seen["last"] = load_name(rows, batch_id)
        append_once(rows, out, seen["last"])

    events.repartition(12).write.parquet(f"{base}/in")
    stream = file_stream(spark, f"{base}/in", events.schema, files_per_batch=2)
    land(stream, write, f"{base}/check").awaitTermination()
    compact_loads(spark, out, events.schema, ["ts"])
    events.where("event_id < 0").write.mode("append").parquet(f"{base}/in")
    land(stream, write, f"{base}/check").awaitTermination()
    compact_loads(spark, out, events.schema, ["ts"])
    # As after a failure: a load that is compacted by now, with rows that it must not add.
    query = seen["last"].rpartition("-")[0]
    append_once(events.limit(10), out, f"{query}-0")
    return read_landed(spark, out, events.schema)


def run_feed(spark, spec, sends, base, end=None):
    """Send messages to a folder and land them, one run of the feed per send.

    Every run goes on where the one before it stopped. Within a send a key occurs once.
    The last run polls until the ``end`` row if there is one.
    """

    count = itertools.count()

    def send(messages):
        # Later sends have smaller partitions and offsets, as only time tells their order.
        sent = next(count)
        messages.select(
            "value",
            F.timestamp_seconds(F.lit(1_700_000_000 + sent)).alias("timestamp"),
            F.lit(9 - sent).alias("partition"),
            "offset",
        ).write.mode(
            "append"
        ).parquet(f"{base}/in")
        return file_stream(spark, f"{base}/in", MESSAGES)

    def start(stream, **more):
        return load_stream(stream, spec, base, f"{base}/check", IMPORT_ID, **more)

    for messages in sends:
        query, _ = start(send(messages))
        query.awaitTermination()
    if end is not None:
        query, signal = start(send(end), until_end=True)
        run_until_end(query, signal, grace_seconds=1)


LINEAGE_SQL = f"CAST({IMPORT_ID} AS BIGINT) AS import_id"


def sensor_feed_query(code):
    spec = feed(code)

    def run(spark, sf_dir):
        base = new_dir(spark, code)
        events = spread(spark, sf_dir, "events")
        rows = records(events, spec)
        if spec.source == "message_array":
            packed = blocks(
                rows.withColumn("_n", F.col(spec.fields[0].source)), "_n", 100
            )
            sent = F.transform("records", lambda r: r.dropFields("_n"))
            messages = packed.select(
                F.to_json(F.array_append(sent, F.lit(None))).alias("value"),
                F.col("block").alias("offset"),
            )
        else:
            messages = encode_messages(rows).select(
                "value", F.lit(0).cast("bigint").alias("offset")
            )
        run_feed(spark, spec, [messages], base)
        return read_table(spark, spec.location(base), spec.target_schema)

    return run, f"SELECT {', '.join(sql_columns(spec))}, {LINEAGE_SQL} FROM events"


def keyed_feed_query(code, changed):
    """Each record twice, the later one with another value; then the end row if there is one."""
    spec = feed(code)

    def run(spark, sf_dir):
        base = new_dir(spark, code)
        events = spread(spark, sf_dir, "events")
        early = records(events, spec, **{changed: F.lit("early")})
        late = records(events, spec)
        key = F.substring_index(spec.keys[0], "-", -1).cast("bigint")
        sends = [encode_messages_with(early, key), encode_messages_with(late, key)]
        end = None
        if spec.control_key:
            end = end_message(spark, spec, 1).withColumn("offset", F.lit(0).cast("bigint"))
        run_feed(spark, spec, sends, base, end)
        return keyed_table(spec, base, 16).read(spark)

    return run, f"SELECT {', '.join(sql_columns(spec))}, {LINEAGE_SQL} FROM events"


def encode_messages_with(rows, offset):
    whole = F.to_json(F.struct(*rows.columns))
    return rows.select(whole.alias("value"), offset.cast("bigint").alias("offset"))


def replicated_feed_query(code):
    """Created, then deleted for errors and created again for views."""
    spec = feed(code)

    def run(spark, sf_dir):
        base = new_dir(spark, code)
        events = spread(spark, sf_dir, "events")
        nothing = F.lit(None).cast(spec.source_schema)

        def changes(rows, operation):
            made = records(rows, spec)
            row = F.struct(*made.columns)
            before, after = (row, nothing) if operation == "d" else (nothing, row)
            change = F.struct(
                F.lit(operation).alias("op"), before.alias("before"), after.alias("after")
            )
            offset = F.substring_index("id", "-", -1).cast("bigint")
            return made.select(F.to_json(change).alias("value"), offset.alias("offset"))

        errors = events.where(F.col("event_type") == "error")
        views = events.where(F.col("event_type") == "view")
        sends = [
            changes(events, "r"),
            changes(errors.unionByName(views), "d"),
            changes(views, "c"),
        ]
        run_feed(spark, spec, sends, base)
        return keyed_table(spec, base, 16).read(spark)

    return run, f"SELECT {', '.join(sql_columns(spec))} FROM events WHERE event_type <> 'error'"


def plan_stream(spark, sf_dir):
    base = new_dir(spark, "F52")
    documents = plan_documents(spark, sf_dir)
    messages = encode_messages_with(documents, F.col("id").cast("bigint"))
    run_feed(spark, feed("F52"), [messages], base)
    return plan_rows(spark, f"{base}/flight_plan")


QUERIES = {
    "q40_stream_land": (landed, "SELECT * FROM events"),
    "q40b_stream_stop": (stopped, "SELECT event_id, event_type FROM events"),
    "q40c_closed_by_key": (
        closed_by_key,
        "SELECT event_type, count(*) AS n_rows, event_type IN ('error', 'view') AS closed "
        "FROM events GROUP BY event_type",
    ),
    "q40d_repeated_messages": (repeated, "SELECT * FROM events"),
    "q41b_compacted_loads": (compacted, "SELECT * FROM events"),
    "f44_eeg_emg": sensor_feed_query("F44"),
    "f45_eye_tracking": sensor_feed_query("F45"),
    "f46_joint_posture": sensor_feed_query("F46"),
    "f47_illuminance": sensor_feed_query("F47"),
    "f48_sorties_batch": keyed_feed_query("F48", "batch_number"),
    "f49_sorties": keyed_feed_query("F49", "pilot"),
    "f50_personnel_stream": keyed_feed_query("F50", "name"),
    "f52_flight_plan_stream": (plan_stream, PLAN_SQL),
    "f55_equipment_code": replicated_feed_query("F55"),
    "f56_equipment_info": replicated_feed_query("F56"),
}
