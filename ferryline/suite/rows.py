"""Projections, filters, scalars, lookups and nesting."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferryline import functions as fn
from ferryline import operators as op
from ferryline.suite.tables import block_of, blocks, table

ZONE = "Asia/Shanghai"


def rename(spark, sf_dir):
    part = op.map_columns(
        table(spark, sf_dir, "part"),
        {"retail_price": "p_retailprice", "part_key": "p_partkey", "part_name": "p_name"},
    )
    return op.rename_by_position(part, ["price", "id", "name"])


def casts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("text_number"),
        F.col("o_totalprice").cast("decimal(38,10)").alias("exact_number"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("text_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("text_time"),
        F.when(F.col("o_orderstatus") == "F", "12.5").otherwise("none").alias("mixed"),
    )
    orders = op.cast_columns(orders, {"text_number": "double", "exact_number": "double"})
    orders = op.cast_columns(orders, {"mixed": "double"}, strict=False)
    return orders.withColumns(
        {
            "text_date": fn.as_date(F.col("text_date")),
            "text_time": fn.as_timestamp(F.col("text_time")),
        }
    )


def stamped(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return op.stamp(events, {"import_id": "bigint"}, import_id=7, batch_number="b-1")


def chained(spark, sf_dir):
    steps = [
        lambda df: df.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount"))),
        None,
        lambda df: df.withColumn("gross", F.col("net") * (1 + F.col("l_tax"))),
        lambda df: df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "net", "gross"),
    ]
    return op.chain(table(spark, sf_dir, "lineitem"), steps)


def exploded(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    parents = blocks(orders, "o_orderkey", 20, F.count(F.lit(1)).alias("members"))
    return op.explode_children(parents, "records", {"parent": "block", "members": "members"})


def struct_projection(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    head = F.struct("o_custkey", "o_totalprice")
    nested = orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "F", head).alias("head")
    )
    return op.struct_rows(nested, "head", {"root_id": "o_orderkey"})


# 10 January 08:00 to 20 January 08:00 in Shanghai, as epoch milliseconds.
RANGE = (1704844800000, 1705708800000)


def time_range(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return op.time_range(events, "ts", *RANGE).select("event_id", "ts", "value")


def optional_range(spark, sf_dir):
    properties = spark.createDataFrame(
        [("events", 0, "value", "reading"), ("events", 1, "ts_ms", "time"),
         ("events", 2, "event_id", "time"), ("part", 0, "p_size", "size")],
        "owner STRING, position INT, code STRING, name STRING",
    )
    events = table(spark, sf_dir, "events").select(
        "event_id", fn.epoch_ms(F.col("ts")).alias("ts_ms")
    )
    part = table(spark, sf_dir, "part").select("p_partkey")

    def column(owner):
        return op.resolve_column(properties.where(F.col("owner") == owner), "time")

    timed = op.optional_time_range(events, column("events"), *RANGE)
    untimed = op.optional_time_range(part, column("part"), *RANGE)
    return op.union_all(
        [
            timed.select(F.lit("events").alias("source"), F.col("event_id").alias("id")),
            untimed.select(F.lit("part").alias("source"), F.col("p_partkey").alias("id")),
        ]
    )


def end_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    control = spark.createDataFrame(
        [(-1, "END_OF_FEED_1"), (-2, None)], "event_id BIGINT, event_type STRING"
    )
    return op.drop_control_rows(events.unionByName(control), "event_type", "END_OF_FEED")


def new_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    offered = orders.select("o_orderkey", F.to_date("o_orderdate").alias("flight_date"))
    loaded = (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(F.to_date("l_shipdate").alias("flight_date"))
    )
    return op.new_keys_only(offered, loaded, ["flight_date"])


def children(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation_id"), "n_name"
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation_id"), "c_custkey", "c_name"
    )
    return op.parent_children(nations, customers, ["nation_id"])


def children_of_two_keys(spark, sf_dir):
    """Children found by two keys of the parent."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id"), "l_quantity"
    )
    pairs = lines.where(F.col("l_quantity") >= 50).select("part_id", "supplier_id").distinct()
    return op.parent_children(pairs, lines, ["part_id", "supplier_id"])


def packed_children(spark, sf_dir):
    """Children that come as one list per parent."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    payloads = blocks(orders, "o_orderkey", 20)
    parents = payloads.select("block", F.concat(F.lit("b"), F.col("block")).alias("batch"))
    return op.parent_children(parents, payloads, ["block"], "records")


def chain_of_lookups(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_linenumber", "l_quantity"
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_name"
    )
    return op.lookup_chain(lines, (orders, ["order_id"]), (customers, ["customer_id"]))


def first_children(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    lists = blocks(orders, "o_orderkey", 20)
    parents = orders.select(block_of("o_orderkey", 20).alias("block")).distinct()
    return op.first_child(parents, lists, ["block"], "records")


def union(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
    )
    return op.union_all([customers, suppliers])


def zone_epoch(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fn.local_to_epoch_ms(F.col("o_orderdate"), ZONE).alias("ms")
    ).withColumn("local", fn.epoch_ms_to_local(F.col("ms"), ZONE))


def date_time_epoch(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    stamped = F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("_flight_01"))
    clock = F.date_format("ts", "HH:mm:ss.SSS")
    return events.select(
        "event_id",
        fn.leading_date(stamped).alias("day"),
        fn.date_time_to_epoch_seconds(fn.leading_date(stamped), clock).alias("seconds"),
    )


def times_of_day(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    time = fn.time_of_day(F.date_format("ts", "HH:mm:ss.SSS"))
    return events.select(
        "event_id",
        fn.time_of_day_text(time).alias("clock"),
        fn.time_of_day_seconds(time).alias("clock_seconds"),
    )


def numerals(spark, sf_dir):
    number = (F.col("p_size") - 1) % 20 + 1
    return table(spark, sf_dir, "part").select(
        "p_partkey", fn.chinese_numeral(number).alias("numeral")
    )


QUERIES = {
    "q11_rename": (
        rename,
        "SELECT p_retailprice AS price, p_partkey AS id, p_name AS name FROM part",
    ),
    "q12_cast": (
        casts,
        """
        SELECT o_orderkey, o_totalprice AS text_number, o_totalprice AS exact_number,
               CAST(o_orderdate AS DATE) AS text_date, o_orderdate AS text_time,
               CASE WHEN o_orderstatus = 'F' THEN CAST(12.5 AS DOUBLE) END AS mixed
        FROM orders
        """,
    ),
    "q13_stamp": (
        stamped,
        "SELECT event_id, value, CAST(7 AS BIGINT) AS import_id, 'b-1' AS batch_number FROM events",
    ),
    "q14_transform_chain": (
        chained,
        """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               l_extendedprice * (1 - l_discount) AS net,
               l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross
        FROM lineitem
        """,
    ),
    "q15_explode_children": (
        exploded,
        """
        SELECT o_orderkey // 20 AS parent, count(*) OVER (PARTITION BY o_orderkey // 20) AS members,
               o_orderkey, o_custkey, o_totalprice FROM orders
        """,
    ),
    "q16_struct_project": (
        struct_projection,
        """
        SELECT o_orderkey AS root_id, o_custkey, o_totalprice
        FROM orders WHERE o_orderstatus <> 'F'
        """,
    ),
    "q17_time_range": (
        time_range,
        f"""
        SELECT event_id, ts, value FROM events
        WHERE epoch_us(ts) // 1000 BETWEEN {RANGE[0]} AND {RANGE[1]}
        """,
    ),
    "q18_optional_filter": (
        optional_range,
        f"""
        SELECT 'events' AS source, event_id AS id FROM events
        WHERE epoch_us(ts) // 1000 BETWEEN {RANGE[0]} AND {RANGE[1]}
        UNION ALL SELECT 'part', p_partkey FROM part
        """,
    ),
    "q19_end_signal": (
        end_rows,
        "SELECT event_id, event_type FROM events UNION ALL SELECT -2, NULL",
    ),
    "q20_new_keys_only": (
        new_keys,
        """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS flight_date FROM orders
        WHERE NOT EXISTS (
            SELECT 1 FROM lineitem WHERE l_returnflag = 'R'
            AND CAST(l_shipdate AS DATE) = CAST(o_orderdate AS DATE))
        """,
    ),
    "q21_parent_children": (
        children,
        """
        SELECT n_nationkey AS nation_id, n_name, c_custkey, c_name
        FROM nation JOIN customer ON c_nationkey = n_nationkey
        """,
    ),
    "q21b_two_key_children": (
        children_of_two_keys,
        """
        SELECT l_partkey AS part_id, l_suppkey AS supplier_id, l_quantity FROM lineitem
        WHERE (l_partkey, l_suppkey) IN
            (SELECT (l_partkey, l_suppkey) FROM lineitem WHERE l_quantity >= 50)
        """,
    ),
    "q21c_packed_children": (
        packed_children,
        """
        SELECT o_orderkey // 20 AS block, 'b' || (o_orderkey // 20) AS batch,
               o_orderkey, o_totalprice FROM orders
        """,
    ),
    "q22_lookup_chain": (
        chain_of_lookups,
        """
        SELECT o_custkey AS customer_id, l_orderkey AS order_id, l_linenumber, l_quantity, c_name
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        """,
    ),
    "q23_first_child": (
        first_children,
        """
        SELECT o_orderkey // 20 AS block, o_orderkey, o_custkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_orderkey // 20 ORDER BY o_orderkey) = 1
        """,
    ),
    "q26_union_all": (
        union,
        """
        SELECT c_custkey AS id, c_name AS name FROM customer
        UNION ALL SELECT s_suppkey, s_name FROM supplier
        """,
    ),
    "q27_zone_epoch": (
        zone_epoch,
        """
        SELECT o_orderkey, epoch_ms(o_orderdate - INTERVAL 8 HOUR) AS ms, o_orderdate AS local
        FROM orders
        """,
    ),
    "q28_date_time_epoch": (
        date_time_epoch,
        """
        SELECT event_id, CAST(ts AS DATE) AS day,
               CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds FROM events
        """,
    ),
    "q29_time_of_day": (
        times_of_day,
        """
        SELECT event_id, strftime(ts, '%H:%M:%S.%g') AS clock,
               strftime(ts, '%H:%M:%S') AS clock_seconds FROM events
        """,
    ),
    "q39_numeral": (
        numerals,
        "SELECT p_partkey, CASE (p_size - 1) % 20 + 1 "
        + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(fn.text.NUMERALS, 1))
        + " END AS numeral FROM part",
    ),
}
