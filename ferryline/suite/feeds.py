"""Every declared file feed, loaded from files made from ``events`` and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferryline import operators as op
from ferryline.feeds import FEEDS, feed
from ferryline.feeds.record_feeds import PLAN_PARTS
from ferryline.functions import local_to_epoch_ms
from ferryline.plans import assets, load, sorties
from ferryline.plans.run import keyed_table
from ferryline.session import new_dir
from ferryline.sinks import read_table
from ferryline.sources import TableRef
from ferryline.suite.derived import comparable, records, sql_columns
from ferryline.suite.tables import blocks, long_blocks, spread, table, write_texts

IMPORT_ID = 42
BATCH = "0007"


def csv_feed_query(code):
    spec = feed(code)

    def run(spark, sf_dir):
        base = new_dir(spark, code)
        on_file = records(spread(spark, sf_dir, "events"), spec)
        on_file.write.option("header", True).csv(f"{base}/in")
        load(spark, spec, f"{base}/in", base, IMPORT_ID, BATCH)
        stored = read_table(spark, spec.location(base), spec.target_schema)
        return comparable(stored, spec)

    lineage = [f"CAST({IMPORT_ID} AS BIGINT) AS import_id"]
    if "batch_number" in spec.lineage:
        lineage.append(f"'{BATCH}' AS batch_number")
    return run, f"SELECT {', '.join(sql_columns(spec) + lineage)} FROM events"


def personnel_file(spark, sf_dir):
    """Two files of records; a person in both keeps the row of the later file."""
    spec = feed("F51")
    base = new_dir(spark, "F51")
    events = table(spark, sf_dir, "events")
    for part, rows in (
        ("first", events),
        ("second", events.where(F.col("event_type") == "click").withColumn("value", F.lit(0.0))),
    ):
        person = records(rows, spec, name=F.concat(F.lit(f"{part}-"), F.col("event_id")))
        numbered = person.select(_number_of("personal_identifier").alias("event_id"), "*")
        packed = long_blocks(numbered, "event_id", 5000)
        texts = packed.select("block", F.to_json("records").alias("value"))
        load(spark, spec, write_texts(texts, f"{base}/{part}"), base, IMPORT_ID)
    return keyed_table(spec, base, 16).read(spark)


def _number_of(column):
    return F.substring_index(column, "-", -1).cast("bigint")


def _personnel_sql():
    spec = feed("F51")
    name = "CASE WHEN event_type = 'click' THEN 'second-' ELSE 'first-' END || event_id"
    columns = ", ".join(sql_columns(spec, name=name))
    return f"SELECT {columns}, CAST({IMPORT_ID} AS BIGINT) AS import_id FROM events"


def _values(part, key):
    """A value for every column of a part of a plan, told apart by column and key."""
    return [
        (F.concat(F.lit(f"{f.source} "), key.cast("string")) if f.source_type == "string"
         else (key % 100).cast(f.source_type)).alias(f.source)
        for f in PLAN_PARTS[part]
    ]


def _values_sql(part, key):
    """The same as one text, in the order of the columns."""
    texts = [
        f"'{f.target} ' || {key}" if f.source_type == "string" else f"CAST({key} % 100 AS VARCHAR)"
        for f in PLAN_PARTS[part]
    ]
    return f"concat_ws('|', {', '.join(texts)})"


def plan_documents(spark, sf_dir):
    """Documents of up to 20 orders each, in the nested shape of a flight plan, all fields set."""
    orders = table(spark, sf_dir, "orders")
    packed = blocks(orders, "o_orderkey", 20, F.max("o_orderdate").alias("day"))
    record = F.col("records")

    def rows(status, part):
        chosen = F.filter(record, lambda r: r["o_orderstatus"] == status)
        return F.transform(chosen, lambda r: F.struct(*_values(part, r["o_orderkey"])))

    return packed.select(
        F.col("block").cast("string").alias("id"),
        F.date_format("day", "yyyy-MM-dd").alias("flight_date"),
        F.col("day").alias("flight_date_time"),
        F.struct(*_values("flight_head", F.col("block"))).alias("flightHead"),
        F.when(
            F.exists(record, lambda r: r["o_orderstatus"] == "F"),
            F.struct(*_values("flight_notes", F.col("block"))),
        ).alias("flightNotes"),
        *[rows(status, part).alias(name) for name, part, status in LISTED],
    )


# Which orders become rows of which list.
LISTED = (
    ("flightCommands", "flight_cmd", "F"),
    ("flightTasks", "flight_task", "P"),
    ("flightPlans", "flight_plan", "O"),
)


def plan_feed_query(code, variant, database):
    def run(spark, sf_dir):
        base = new_dir(spark, code)
        documents = plan_documents(spark, sf_dir)
        texts = documents.select(
            F.col("id").alias("block"), F.to_json(F.struct("*")).alias("value")
        )
        lists = (
            texts.groupBy(F.expr("concat(CAST(block AS BIGINT) DIV 1000, '-', CAST(block AS BIGINT) % 2)").alias("block"))
            .agg(F.collect_list("value").alias("all"))
            .select("block", F.concat(F.lit("["), F.array_join("all", ","), F.lit("]")).alias("value"))
        )
        write_texts(lists.withColumn("part", F.substring_index("block", "-", -1)), f"{base}/in", "part")
        # Two sets of files under one import; the first is loaded once more.
        for part in (0, 1, 0):
            load(spark, feed(code), f"{base}/in/part={part}", base, IMPORT_ID, variant=variant)
        return plan_rows(spark, f"{base}/{database}")

    return run, PLAN_SQL


def plan_rows(spark, base):
    """All tables of the documents in one shape: table, id of the root, all columns as a text."""

    def read(name, root, *columns):
        stored = read_table(spark, f"{base}/{name}")
        return stored.select(
            F.lit(name).alias("target"),
            F.col(root).cast("string").alias("root_id"),
            F.concat_ws("|", *columns).alias("content"),
            "import_id",
        )

    day = F.col("flight_date_time").cast("date")
    parts = [read("flight_plan_root", "id", F.col("flight_date"), day)]
    parts += [read(name, "root_id", *[f.target for f in fields]) for name, fields in PLAN_PARTS.items()]
    return op.union_all(parts)


def _plan_sql():
    block, key = "CAST(o_orderkey // 20 AS VARCHAR)", "o_orderkey // 20"
    day = "CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR)"
    parts = [
        f"SELECT 'flight_plan_root' AS target, {block} AS root_id, {day} || '|' || {day} AS content "
        "FROM orders GROUP BY 2",
        f"SELECT DISTINCT 'flight_head', {block}, {_values_sql('flight_head', f'({key})')} FROM orders",
        f"SELECT DISTINCT 'flight_notes', {block}, {_values_sql('flight_notes', f'({key})')} "
        "FROM orders WHERE o_orderstatus = 'F'",
    ] + [
        f"SELECT '{part}', {block}, {_values_sql(part, 'o_orderkey')} "
        f"FROM orders WHERE o_orderstatus = '{status}'"
        for _, part, status in LISTED
    ]
    return (
        f"SELECT *, CAST({IMPORT_ID} AS BIGINT) AS import_id FROM ({' UNION ALL '.join(parts)})"
    )


PLAN_SQL = _plan_sql()


def sortie_payloads(spark, sf_dir):
    """Batches from one set of bodies, the sorties of each batch from another."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    listed = blocks(orders, "o_orderkey", 20)
    batch = F.struct(
        F.concat(F.lit("b"), F.col("block")).alias("id"), F.col("block").cast("string").alias("batch_number")
    )
    batches = sorties.batch_records(
        listed.select(F.to_json(F.struct(F.array(batch).alias("data"))).alias("value"))
    )
    sortie = F.transform(
        "records",
        lambda r: F.struct(
            r["o_orderkey"].cast("string").alias("sortie_id"),
            r["o_orderstatus"].alias("sortie_number"),
        ),
    )
    bodies = listed.select(
        F.concat(F.lit("b"), F.col("block")).alias("batch_id"),
        F.to_json(F.struct(sortie.alias("data"))).alias("value"),
    )
    return sorties.sortie_records(batches, bodies).select(
        F.col("sortie_id").cast("bigint").alias("o_orderkey"),
        F.col("sortie_number").alias("o_orderstatus"),
    )


def asset_copy(spark, sf_dir):
    """One sortie's assets: metadata from landed bodies, then the cut of two data tables."""
    orders = table(spark, sf_dir, "orders")
    base = new_dir(spark, "assets")
    timed = f"{base}/source/timed"
    orders.select(
        "o_orderkey", local_to_epoch_ms(F.col("o_orderdate"), assets.ZONE).alias("t0")
    ).write.parquet(timed)
    places = {
        ("recorded", "timed"): TableRef("parquet", timed, keys=("o_orderkey",)),
        ("fixed", "untimed"): TableRef("parquet", f"{sf_dir}/part.parquet", keys=("p_partkey",)),
    }
    listed = orders.select(
        F.lit("s-1").alias("sortie_number"), F.lit("J-1").alias("airplane_number"),
        F.lit("v1").alias("icd_version"), "o_orderdate",
    )
    flown = listed.groupBy("sortie_number", "airplane_number", "icd_version").agg(
        F.expr("min(o_orderdate) + INTERVAL 100 DAY").alias("car_start_time"),
        F.expr("max(o_orderdate) - INTERVAL 100 DAY").alias("car_end_time"),
    )
    sortie = assets.find_sortie(flown, "s-1")
    summary = (
        '{"result":[{"id":1,"full_name":"timed","db_name":"recorded"},'
        '{"id":2,"full_name":"untimed","db_name":"fixed"}]}'
    )
    properties = {
        1: '[{"code":"c0","name":"x"},{"code":"t0","name":"消息发生时间"},{"code":"t1","name":"消息发生时间"}]',
        2: '[{"code":"c0","name":"x"}]',
    }
    lists = flown.select(
        F.col("airplane_number").alias("weapon_model"), "icd_version", F.lit(summary).alias("value")
    )
    configs = spark.createDataFrame(
        [
            (i, f'{{"result":[{{"assetModel":{{"id":{i}0,"name":"m{i}"}},"propertyList":{p}}}]}}')
            for i, p in properties.items()
        ],
        "id BIGINT, value STRING",
    )
    frames = assets.asset_frames(sortie, lists, configs, IMPORT_ID)
    for _ in range(2):
        assets.save_metadata(frames, base)
    columns = assets.time_columns(frames.properties)
    tables = assets.asset_tables(frames.summaries, lambda db, name: places[db, name])
    for _ in range(2):
        copies = assets.copy_asset_tables(spark, sortie, tables, columns, base)
    stored = [
        copies["timed"].select(
            F.lit("timed").alias("target"), F.col("o_orderkey").cast("string").alias("id")
        ),
        copies["untimed"].select(
            F.lit("untimed").alias("target"), F.col("p_partkey").cast("string").alias("id")
        ),
    ]
    for spec, key in ((assets.SUMMARY, "full_name"), (assets.MODEL, "name")):
        rows = assets.metadata_table(spec, base).read(spark)
        stored.append(rows.select(F.lit(spec.table).alias("target"), F.col(key).alias("id")))
    props = assets.metadata_table(assets.PROPERTY, base).read(spark)
    stored.append(
        props.select(
            F.lit(assets.PROPERTY.table).alias("target"),
            F.concat_ws(" ", "sortie_number", "model_id", "code").alias("id"),
        )
    )
    return op.union_all(stored)


ASSET_SQL = """
    SELECT 'timed' AS target, CAST(o_orderkey AS VARCHAR) AS id FROM orders
    WHERE o_orderdate BETWEEN (SELECT min(o_orderdate) + INTERVAL 100 DAY FROM orders)
                          AND (SELECT max(o_orderdate) - INTERVAL 100 DAY FROM orders)
    UNION ALL SELECT 'untimed', CAST(p_partkey AS VARCHAR) FROM part
    UNION ALL SELECT * FROM (VALUES
        ('asset_summary', 'timed'), ('asset_summary', 'untimed'),
        ('asset_table_model', 'm1'), ('asset_table_model', 'm2'),
        ('asset_table_property', 's-1 10 c0'), ('asset_table_property', 's-1 10 t0'),
        ('asset_table_property', 's-1 10 t1'), ('asset_table_property', 's-1 20 c0'))
"""


QUERIES = {
    f"{code.lower()}_{spec.table}": csv_feed_query(code)
    for code, spec in FEEDS.items()
    if spec.source == "csv"
} | {
    "f49b_sortie_payloads": (sortie_payloads, "SELECT o_orderkey, o_orderstatus FROM orders"),
    "f51_personnel_file": (personnel_file, _personnel_sql()),
    "f53_flight_plan_file": plan_feed_query("F53", "plan", "flight_plan"),
    "f54_flight_plan_dynamic": plan_feed_query("F54", "dynamic", "flight_plan_dynamic"),
    "f54b_flight_plan_implementation": plan_feed_query(
        "F54", "implementation", "flight_plan_implementation"
    ),
    "f57_asset_copy": (asset_copy, ASSET_SQL),
}
