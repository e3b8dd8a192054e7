"""Writers: append, batch replacement, fan-out, routing, copies and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferryline import operators as op
from ferryline.session import new_dir
from ferryline.sinks import (
    Child,
    append,
    append_once,
    copy_tables,
    export_json,
    fan_out,
    ordered_by,
    read_table,
    replace_batch,
    replace_batches,
    route,
)
from ferryline.sources import TableRef
from ferryline.sources.files import json_line_files
from ferryline.suite.tables import blocks, table


def appended(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = new_dir(spark, "append")
    finished = F.col("o_orderstatus") == "F"
    append(orders.where(finished), path)
    append(orders.where(~finished), path)
    return read_table(spark, path, orders.schema)


def batches_replaced(spark, sf_dir):
    """Every event type is a batch; all are loaded, then one again with other values."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "value", F.col("event_type").alias("batch_number")
    )
    path = new_dir(spark, "batches")
    replace_batches(events, path)
    clicks = events.where(F.col("batch_number") == "click").select(
        "event_id", (F.col("value") * 2).alias("value")
    )
    replace_batch(clicks, path, "click")
    return read_table(spark, path, events.schema)


def batch_loaded_twice(spark, sf_dir):
    """The first slice: stamp, cut by time, load one batch twice, count per batch."""
    events = op.stamp(
        op.time_range(table(spark, sf_dir, "events"), "ts", 1704844800000, 1705708800000),
        {"import_id": "bigint"},
        import_id=1,
    )
    path = new_dir(spark, "twice")
    replace_batch(events, path, "b-1")
    replace_batch(events, path, "b-1")
    stored = op.stamp(events, batch_number="b-1").schema
    return op.batch_counts(read_table(spark, path, stored), "batch_number")


def fanned_out(spark, sf_dir):
    """One nested frame of orders into a root table and tables of its parts."""
    orders = table(spark, sf_dir, "orders")
    roots = blocks(
        orders, "o_orderkey", 20, F.max_by("o_orderstatus", "o_orderkey").alias("status")
    ).withColumn("head", F.struct("status", F.size("records").alias("members")))
    base = new_dir(spark, "fanout")
    children = [
        Child("heads", lambda d: op.struct_rows(d, "head", {"root_id": "block"})),
        Child("orders", lambda d: op.explode_children(d, "records", {"root_id": "block"})),
    ]
    root = Child("roots", lambda d: d.select("block"))
    for _ in range(2):
        fan_out(roots, children, root, base, load_id=1)
    heads = F.concat_ws(" ", "status", "members")
    return op.union_all(
        [
            read_table(spark, f"{base}/{name}").select(
                F.lit(name).alias("target"), F.col(key).alias("id"), value.alias("value")
            )
            for name, key, value in (
                ("roots", "block", F.lit(None).cast("string")),
                ("heads", "root_id", heads),
                ("orders", "root_id", F.col("o_orderkey").cast("string")),
            )
        ]
    )


def routed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    base = new_dir(spark, "route")
    targets = {"F": "finished", "O": "open", "P": "pending"}
    for status in targets:
        rows = orders.where(F.col("o_orderstatus") == status)
        append(rows, f"{base}/{route(status, targets)}")
    return op.union_all(
        [
            read_table(spark, f"{base}/{name}", orders.schema).select(
                "o_orderkey", F.lit(name).alias("target")
            )
            for name in targets.values()
        ]
    )


COPIED = ("o_orderpriority", "c_mktsegment", "p_brand")


def copied(spark, sf_dir):
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey"}
    sources = {
        name: TableRef("parquet", f"{sf_dir}/{name}.parquet", keys=(key,) if name != "part" else ())
        for name, key in keys.items()
    }
    cut = {"orders": lambda df: op.time_range(df, "o_orderdate", 883612800000, 4102444800000)}
    copies = copy_tables(spark, sources, new_dir(spark, "copy"), cut)
    return op.union_all(
        [
            copies[name].select(
                F.lit(name).alias("source"), F.col(key).alias("id"), F.col(value).alias("value")
            )
            for (name, key), value in zip(keys.items(), COPIED)
        ]
    )


# What a source has in its first to fourth state, as (column, type).
STATES = (
    (("o_orderkey", "bigint"), ("o_shippriority", "smallint"), ("cents", "decimal(9,1)"),
     ("day", "date"), ("o_orderstatus", "string")),
    (("o_orderkey", "bigint"), ("o_shippriority", "bigint"), ("cents", "decimal(20,2)"),
     ("day", "timestamp_ntz"), ("o_orderstatus", "string")),
    (("o_clerk", "string"), ("o_orderkey", "bigint"), ("o_shippriority", "bigint"),
     ("cents", "decimal(20,2)"), ("day", "timestamp_ntz"), ("o_orderstatus", "string")),
    (("o_clerk", "string"), ("o_orderkey", "bigint"), ("o_shippriority", "int"),
     ("cents", "decimal(20,2)"), ("day", "date")),
)


def copied_while_changing(spark, sf_dir):
    """Copies of a source that has other columns each time: wider, added, dropped, narrower.

    Each state of the source has the orders of one remainder of the key, and the keyed copy
    gets those of the state before again.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lit(7).alias("o_shippriority"),
        F.col("o_totalprice").cast("decimal(20,2)").alias("cents"),
        F.col("o_orderdate").alias("day"),
        "o_orderstatus",
        F.col("o_orderpriority").alias("o_clerk"),
    )
    base = new_dir(spark, "changing")
    state = F.col("o_orderkey") % len(STATES)
    for i, columns in enumerate(STATES):
        for name, rows in (("keyed", state.isin(i, max(0, i - 1))), ("plain", state == i)):
            kept = orders.where(rows).withColumn("cents", F.floor(F.abs("cents") % 1000))
            kept.select(*[F.col(c).cast(t).alias(c) for c, t in columns]).write.parquet(
                f"{base}/source/{i}/{name}"
            )
        sources = {
            "keyed": TableRef("parquet", f"{base}/source/{i}/keyed", keys=("o_orderkey",)),
            "plain": TableRef("parquet", f"{base}/source/{i}/plain"),
        }
        copies = copy_tables(spark, sources, f"{base}/copy", order={"plain": "day"})
    return op.union_all(
        [
            copies[name].select(
                F.lit(name).alias("target"),
                "o_orderkey",
                "o_shippriority",
                F.col("cents").cast("double").alias("cents"),
                "day",
                "o_orderstatus",
                "o_clerk",
            )
            for name in ("keyed", "plain")
        ]
    )


def cut_after_ordering(spark, sf_dir):
    """Rows between two times of a table that was laid out by time when it was written."""
    path = new_dir(spark, "ordered")
    append(ordered_by(table(spark, sf_dir, "events"), "ts"), path)
    return op.time_range(read_table(spark, path), "ts", 1704844800000, 1705708800000)


def exported(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = export_json(customer, new_dir(spark, "export"), "customer", 1704844800000)
    return json_line_files(spark, path, customer.schema)


def delivered_twice(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = new_dir(spark, "replay")
    append_once(events, path, 7)
    append_once(events, path, 7)
    return read_table(spark, path, events.schema)


CHANGING_SQL = """
    WITH source AS (
        SELECT o_orderkey, CAST(7 AS BIGINT) AS o_shippriority,
               floor(abs(CAST(o_totalprice AS DECIMAL(20, 2))) % 1000)::DOUBLE AS cents,
               CAST(o_orderdate AS TIMESTAMP) AS day, o_orderstatus, o_orderpriority AS o_clerk,
               o_orderkey % 4 AS state
        FROM orders
    ), copies AS (
        SELECT 'keyed' AS target, least(state + 1, 3) AS last, * FROM source
        UNION ALL SELECT 'plain', state, * FROM source
    )
    SELECT target, o_orderkey, o_shippriority, cents,
           CASE WHEN last IN (0, 3) THEN date_trunc('day', day)::TIMESTAMP ELSE day END AS day,
           CASE WHEN last < 3 THEN o_orderstatus END AS o_orderstatus,
           CASE WHEN last >= 2 THEN o_clerk END AS o_clerk
    FROM copies
"""


QUERIES = {
    "q17b_time_layout": (
        cut_after_ordering,
        """
        SELECT * FROM events
        WHERE epoch_us(ts) // 1000 BETWEEN 1704844800000 AND 1705708800000
        """,
    ),
    "q30_append": (appended, "SELECT * FROM orders"),
    "q33_replace_batch": (
        batches_replaced,
        """
        SELECT event_id, CASE WHEN event_type = 'click' THEN value * 2 ELSE value END AS value,
               event_type AS batch_number FROM events
        """,
    ),
    "q33b_batch_loaded_twice": (
        batch_loaded_twice,
        """
        SELECT 'b-1' AS batch_number, count(*) AS row_count FROM events
        WHERE epoch_us(ts) // 1000 BETWEEN 1704844800000 AND 1705708800000
        """,
    ),
    "q34_fanout_counts": (
        fanned_out,
        """
        SELECT DISTINCT 'roots' AS target, o_orderkey // 20 AS id, CAST(NULL AS VARCHAR) AS value
        FROM orders
        UNION ALL
        SELECT 'heads', o_orderkey // 20,
               arg_max(o_orderstatus, o_orderkey) || ' ' || CAST(count(*) AS VARCHAR)
        FROM orders GROUP BY o_orderkey // 20
        UNION ALL SELECT 'orders', o_orderkey // 20, CAST(o_orderkey AS VARCHAR) FROM orders
        """,
    ),
    "q35_variant_route": (
        routed,
        """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open'
               ELSE 'pending' END AS target FROM orders
        """,
    ),
    "q36_table_copy": (
        copied,
        """
        SELECT 'orders' AS source, o_orderkey AS id, o_orderpriority AS value FROM orders
        WHERE epoch_us(o_orderdate) // 1000 BETWEEN 883612800000 AND 4102444800000
        UNION ALL SELECT 'customer', c_custkey, c_mktsegment FROM customer
        UNION ALL SELECT 'part', p_partkey, p_brand FROM part
        """,
    ),
    "q36b_changing_source": (copied_while_changing, CHANGING_SQL),
    "q38_json_export": (exported, "SELECT * FROM customer"),
    "q41_replay_safe_append": (delivered_twice, "SELECT * FROM events"),
}
