"""Aggregation, keyed frames and keyed tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ferryline import operators as op
from ferryline.session import new_dir
from ferryline.sinks import KeyedTable, append, read_table
from ferryline.sources import decode_changes, snapshot_changes
from ferryline.sources.changelog import DELETED
from ferryline.suite.tables import spread, table


def change_messages(spark, sf_dir):
    """Every order created; finished ones deleted later, pending ones updated later."""
    orders = spread(spark, sf_dir, "orders")
    row = F.struct(*orders.columns)
    cheaper = F.struct(
        *[(F.col(c) / 2 if c == "o_totalprice" else F.col(c)).alias(c) for c in orders.columns]
    )
    nothing = F.lit(None).cast(row_type(orders))

    def change(operation, before, after, sequence):
        return F.struct(
            F.lit(sequence).alias("sequence"),
            F.to_json(
                F.struct(F.lit(operation).alias("op"), before.alias("before"), after.alias("after"))
            ).alias("value"),
        )

    created = change("c", nothing, row, 1)
    later = (
        F.when(F.col("o_orderstatus") == "F", F.array(created, change("d", row, nothing, 2)))
        .when(F.col("o_orderstatus") == "P", F.array(created, change("u", row, cheaper, 2)))
        .otherwise(F.array(created))
    )
    return orders.select(F.inline(later)), orders.schema


def row_type(df):
    return StructType([StructField(f.name, f.dataType) for f in df.schema])


def _orders_table(spark, sf_dir, label):
    orders = table(spark, sf_dir, "orders")
    return orders, KeyedTable(new_dir(spark, label), orders.schema, ("o_orderkey",), buckets=8)


CHANGES_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN o_totalprice / 2 ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders WHERE o_orderstatus <> 'F'
"""


def replicate(spark, sf_dir):
    messages, schema = change_messages(spark, sf_dir)
    changes = decode_changes(messages, schema, "value", ["sequence"])
    _, target = _orders_table(spark, sf_dir, "changes")
    target.apply_changes(changes, ["sequence"])
    return target.read(spark)


def replay(spark, sf_dir):
    """The same change log on a frame that already holds the orders to be deleted."""
    messages, schema = change_messages(spark, sf_dir)
    changes = decode_changes(messages, schema, "value", ["sequence"])
    stored = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return op.apply_changes(stored, changes, ["o_orderkey"], ["sequence"])


def order_changes(orders):
    """Pending orders changed twice, and a new order for each open one."""
    pending = orders.where(F.col("o_orderstatus") == "P")
    fresh = orders.where(F.col("o_orderstatus") == "O").withColumn(
        "o_orderkey", -F.col("o_orderkey") - 1
    )
    return op.union_all(
        [
            pending.withColumns({"o_totalprice": F.col("o_totalprice") + 1, "version": F.lit(1)}),
            pending.withColumns({"o_totalprice": F.col("o_totalprice") + 2, "version": F.lit(2)}),
            fresh.withColumn("version", F.lit(1)),
        ]
    )


UPSERT_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 2 ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority FROM orders
    UNION ALL
    SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderstatus = 'O'
"""


def upsert_table(spark, sf_dir):
    orders, target = _orders_table(spark, sf_dir, "upsert")
    target.upsert(orders, ["o_orderdate"])
    target.upsert(order_changes(orders), ["version"])
    return target.read(spark)


def late_versions(spark, sf_dir):
    """As ``upsert_table``, but the second version of an order comes a load before the first."""
    orders, target = _orders_table(spark, sf_dir, "late-versions")
    changes = order_changes(orders)
    for part in (
        changes.where("version = 2"),
        orders.withColumn("version", F.lit(0)),
        changes.where("version = 1"),
    ):
        target.upsert(part, ["version"], across_loads=True)
    return target.read(spark)


def late_changes(spark, sf_dir):
    """Deletes and updates first, then what they change, then older deletes of all orders."""
    messages, schema = change_messages(spark, sf_dir)
    changes = decode_changes(messages, schema, "value", ["sequence"])
    orders, target = _orders_table(spark, sf_dir, "late-changes")
    older = orders.withColumns({"sequence": F.lit(0), DELETED: F.lit(True)})
    for part in (changes.where("sequence = 2"), changes.where("sequence = 1"), older):
        target.apply_changes(part, ["sequence"], across_loads=True)
    return target.read(spark)


def snapshot_handover(spark, sf_dir):
    """A snapshot read in two parts at different places of a log that is applied around it.

    The log creates all orders (10), makes pending ones cheaper (20), deletes finished ones
    (30) and makes open ones dearer (40). The parts are read at 15 and 25, and hold what the
    table held then; part of the log is applied before them, the rest and that part again
    after them.
    """
    orders, target = _orders_table(spark, sf_dir, "handover")
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")

    def changes(rows, place, deleted=False):
        return rows.withColumns({"place": F.lit(place), DELETED: F.lit(deleted)})

    pending = orders.where(status == "P").withColumn("o_totalprice", price / 2)
    dearer = orders.where(status == "O").withColumn("o_totalprice", price + 1)
    created, cheaper = changes(orders, 10), changes(pending, 20)
    rest = changes(orders.where(status == "F"), 30, True).unionByName(changes(dearer, 40))
    half = F.col("o_orderkey") % 2 == 0
    as_of_25 = orders.where(status != "P").unionByName(pending)
    parts = [(orders.where(half), 15), (as_of_25.where(~half), 25)]
    loads = [
        cheaper,
        *[snapshot_changes(rows, {"place": F.lit(place)}) for rows, place in parts],
        created.unionByName(cheaper).unionByName(rest),
    ]
    for load in loads:
        target.apply_changes(load, ["place"], across_loads=True)
    return target.read(spark)


HANDOVER_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE o_orderstatus WHEN 'P' THEN o_totalprice / 2 ELSE o_totalprice + 1 END AS o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders WHERE o_orderstatus <> 'F'
"""


def late_rows_frame(spark, sf_dir):
    """The ordered merge as frames: a later load of older versions, and few of newer ones."""
    orders = table(spark, sf_dir, "orders")
    key = ["o_orderkey"]
    changes = order_changes(orders)
    second, first = (
        op.latest_changes(changes.where(f"version = {v}"), key, ["version"]) for v in (2, 1)
    )
    stored = op.latest_changes(orders.withColumn("version", F.lit(0)), key, ["version"])
    merged = op.merge_ordered(op.merge_ordered(stored, second, key), first, key)
    return merged.where(~F.col(DELETED)).select(*orders.columns)


def upsert_frame(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return op.upsert(orders, order_changes(orders), ["o_orderkey"], ["version"])


LINE_KEY = ["l_orderkey", "l_linenumber"]


def replacement_lines(lines):
    """One new row for each (order, line) that has a returned line."""
    keys = lines.where(F.col("l_returnflag") == "R").select(*LINE_KEY).distinct()
    values = {
        "l_partkey": F.lit(0).cast("bigint"),
        "l_suppkey": F.lit(0).cast("bigint"),
        "l_quantity": F.lit(1.0),
        "l_extendedprice": F.lit(0.0),
        "l_discount": F.lit(0.0),
        "l_tax": F.lit(0.0),
        "l_returnflag": F.lit("X"),
        "l_linestatus": F.lit("X"),
        "l_shipdate": F.lit("2000-01-01").cast("timestamp_ntz"),
    }
    return keys.withColumns(values).select(*lines.columns)


REPLACE_SQL = """
    SELECT * FROM lineitem WHERE (l_orderkey, l_linenumber) NOT IN
        (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_returnflag = 'R')
    UNION ALL
    SELECT DISTINCT l_orderkey, CAST(0 AS BIGINT), CAST(0 AS BIGINT), l_linenumber, 1.0::DOUBLE,
           0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 'X', 'X', TIMESTAMP '2000-01-01'
    FROM lineitem WHERE l_returnflag = 'R'
"""


def delete_insert_table(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    target = KeyedTable(new_dir(spark, "lines"), lines.schema, tuple(LINE_KEY), buckets=8)
    target.delete_insert(lines)
    target.delete_insert(replacement_lines(lines))
    return target.read(spark)


def delete_insert_frame(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return op.delete_insert(lines, replacement_lines(lines), LINE_KEY)


def counts(spark, sf_dir):
    return op.batch_counts(table(spark, sf_dir, "events"), "event_type")


def counts_by_user(spark, sf_dir):
    """Events gathered by type, so that each directory gets few files; then counts per user."""
    path = new_dir(spark, "gathered")
    events = table(spark, sf_dir, "events")
    append(op.partition_by_key(events, ["event_type"]), path, ["event_type"])
    return op.batch_counts(read_table(spark, path, events.schema), "user_id")


def latest(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return op.latest_per_key(events, ["user_id"], ["ts", "event_id"])


def first(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    order = [F.col("l_shipdate"), *[F.col(c) for c in lines.columns if c != "l_shipdate"]]
    return op.first_row(lines, *order)


QUERIES = {
    "q08_changelog_apply": (replicate, CHANGES_SQL),
    "q08b_changelog_frame": (replay, CHANGES_SQL),
    "q08c_late_changes": (late_changes, CHANGES_SQL),
    "q08d_snapshot_handover": (snapshot_handover, HANDOVER_SQL),
    "q10b_first_row": (
        first,
        "SELECT * FROM lineitem ORDER BY l_shipdate, l_orderkey, l_partkey, l_suppkey, "
        "l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
        "l_linestatus LIMIT 1",
    ),
    "q24_batch_count": (
        counts,
        "SELECT event_type, count(*) AS row_count FROM events GROUP BY event_type",
    ),
    "q25_key_partition": (
        counts_by_user,
        "SELECT user_id, count(*) AS row_count FROM events GROUP BY user_id",
    ),
    "q31_upsert": (upsert_table, UPSERT_SQL),
    "q31b_upsert_frame": (upsert_frame, UPSERT_SQL),
    "q31c_latest_per_key": (
        latest,
        """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
        """,
    ),
    "q31d_late_versions": (late_versions, UPSERT_SQL),
    "q31e_late_versions_frame": (late_rows_frame, UPSERT_SQL),
    "q32_delete_insert": (delete_insert_table, REPLACE_SQL),
    "q32b_delete_insert_frame": (delete_insert_frame, REPLACE_SQL),
}
