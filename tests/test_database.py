"""The database target, with the connection replaced: what is staged, and what is run then."""

import datetime
import re

import pytest
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from ferryline.feeds import FEEDS
from ferryline.operators.keyed import ORDER
from ferryline.plans import load, load_stream
from ferryline.plans.run import database_table
from ferryline.sinks import Database
from ferryline.sources.changelog import DELETED
from ferryline.streaming import file_stream

MESSAGES = "value STRING, timestamp TIMESTAMP, partition INT, offset BIGINT"


class Recorder:
    """Takes what a database would."""

    def __init__(self, lost=False):
        self.calls, self.staged, self.schemas, self.lost = [], {}, {}, lost

    def run(self, spark, url, statements, options):
        self.calls.append(statements)

    def write(self, df, url, table, writers, options):
        self.calls.append(table)
        if self.lost:
            raise RuntimeError("lost")
        self.staged.setdefault(table, []).append([r.asDict() for r in df.collect()])
        self.schemas[table] = df.schema

    def database(self):
        return Database("jdbc:x", 4, {"user": "u"}, self.write, self.run)


def nothing(spark, spec):
    return spark.createDataFrame([], spec.target_schema)


def send(spark, path, *values):
    at = datetime.datetime(2024, 5, 1)
    messages = [(v, at, 0, i) for i, v in enumerate(values)]
    spark.createDataFrame(messages, MESSAGES).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("spec", FEEDS.values(), ids=lambda s: s.code)
def test_every_feed(spark, spec):
    """Staged columns are those that the statements name, in types a JDBC writer knows."""
    taken = Recorder()
    table, rows = database_table(spec, taken.database()), nothing(spark, spec)
    if spec.keys:
        assert table.ordered
        table.upsert(rows, [spec.keys[0]], across_loads=True)
    elif spec.mode == "replace_batch":
        table.replace_batch(rows, "b'1")
    else:
        table.append_once(rows, "q-1")
    make, staging, statements = taken.calls
    assert staging == f"{spec.table}_staging"
    names = taken.schemas[staging].names
    used = {n for text in (*make, *statements) for n in re.findall(r"`(\w+)`", text)}
    assert set(names) <= used
    assert used <= {*names, spec.table, staging, f"{spec.table}_loads"}
    known = {"string", "bigint", "int", "smallint", "tinyint", "double", "date", "timestamp_ntz"}
    for f in taken.schemas[staging]:
        kind = f.dataType.simpleString()
        binary = f.name == ORDER and isinstance(f.dataType, BinaryType)
        mark = f.name == DELETED and isinstance(f.dataType, BooleanType)
        assert kind in known or kind.startswith("decimal") or binary or mark, (f.name, kind)


def small(taken, keys=("id",), ordered=False):
    schema = StructType([StructField("id", LongType()), StructField("v", StringType())])
    return taken.database().table("t", schema, keys, ordered)


def test_statements(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, None, 1)], "id BIGINT, v STRING, n INT")
    taken = Recorder()
    small(taken).upsert(rows, ["n"])
    assert taken.calls[0] == [
        "DROP TABLE IF EXISTS `t_staging`",
        "CREATE TABLE `t_staging` AS SELECT `id`, `v`, 0 AS `_row`, FALSE AS `_deleted` FROM `t` WHERE FALSE",
        "ALTER TABLE `t_staging` MODIFY `_row` BIGINT NOT NULL",
    ]
    assert taken.calls[2] == [
        "DELETE t FROM `t` t JOIN `t_staging` s ON t.`id` = s.`id` WHERE s.`_deleted`",
        "INSERT INTO `t` (`id`, `v`) SELECT `id`, `v` FROM "
        "(SELECT DISTINCT `_row`, `id`, `v`, `_deleted` FROM `t_staging`) s WHERE NOT s.`_deleted` "
        "ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)",
    ]
    staged = sorted((r["id"], r["v"], r[DELETED]) for r in taken.staged["t_staging"][0])
    assert staged == [(1, "b", False), (2, None, False)]
    taken = Recorder()
    small(taken, ordered=True).upsert(rows, ["n"], across_loads=True)
    counts = "`t`.`_order` IS NULL OR VALUES(`_order`) IS NULL OR VALUES(`_order`) >= `t`.`_order`"
    text = taken.calls[2][0]
    assert text.startswith("INSERT INTO `t` (`id`, `v`, `_order`, `_deleted`) SELECT `id`, `v`, `_order`, `_deleted` FROM")
    assert text.endswith(f"`_order` = IF({counts}, VALUES(`_order`), `t`.`_order`)")
    assert text.count(f"IF({counts}") == 3
    with pytest.raises(ValueError, match="no keys"):
        small(taken, keys=()).upsert(rows, ["n"])


def test_changes_keep_their_deletes(spark):
    rows = spark.createDataFrame(
        [(1, "a", 1, False), (1, "a", 2, True)], f"id BIGINT, v STRING, n INT, {DELETED} BOOLEAN"
    )
    for ordered in (False, True):
        taken = Recorder()
        small(taken, ordered=ordered).apply_changes(rows, ["n"], across_loads=ordered)
        (row,) = taken.staged["t_staging"][0]
        assert row["id"] == 1 and row[DELETED] and ((ORDER in row) == ordered)


def test_equal_rows_of_a_load_have_places_of_their_own(spark):
    taken = Recorder()
    rows = spark.createDataFrame([(1, "a")] * 5, "id BIGINT, v STRING").repartition(3)
    small(taken, ()).append(rows)
    assert len({r["_row"] for r in taken.staged["t_staging"][0]}) == 5
    assert "DISTINCT `_row`" in taken.calls[2][0]


def test_a_lost_load_changes_nothing(spark):
    taken = Recorder(lost=True)
    with pytest.raises(RuntimeError):
        small(taken, ()).replace_batch(spark.createDataFrame([(1, "a")], "id BIGINT, v STRING"), "a", "v")
    assert len(taken.calls) == 2 and all("INSERT" not in s for s in taken.calls[0])


def test_batches_are_quoted(spark):
    taken = Recorder()
    rows = spark.createDataFrame([(1, "x")], "id BIGINT, v STRING")
    small(taken, ()).replace_batch(rows, "it's \\", "v")
    assert taken.calls[2][0] == "DELETE FROM `t` WHERE `v` = 'it''s \\\\'"
    assert taken.staged["t_staging"][0][0]["v"] == "it's \\"


def test_files_and_streams_reach_the_database(spark, tmp_path):
    spec, taken = FEEDS["F33"], Recorder()
    names = ",".join(f.source for f in spec.fields)
    (tmp_path / "a.csv").write_text(f"{names}\n{',' * (len(spec.fields) - 1)}\n")
    load(spark, spec, str(tmp_path / "a.csv"), "unused", 7, "b-1", target=taken.database())
    (row,) = taken.staged[f"{spec.table}_staging"][0]
    assert (row["import_id"], row["batch_number"]) == (7, "b-1")

    for code, value in (("F44", '{"pilot_id":7}'), ("F49", '{"sortie_id":"1"}'), ("F52", '{"id":"p","flightTasks":[{},{}]}')):
        spec, taken, source = FEEDS[code], Recorder(), str(tmp_path / code)
        send(spark, source, value)
        stream = file_stream(spark, source, MESSAGES)
        query, _ = load_stream(stream, spec, str(tmp_path), f"{source}-check", 5, target=taken.database())
        query.awaitTermination()
        if spec.mode == "fan_out":
            tables = [c for c in taken.calls if isinstance(c, str)]
            assert len(tables) == 6 and tables[-1] == "flight_plan_root_staging"
            assert len(taken.staged["flight_task_staging"][0]) == 2
        else:
            (row,) = taken.staged[f"{spec.table}_staging"][0]
            assert row["import_id"] == 5
        last = taken.calls[-1]
        assert (ORDER in last[0]) if spec.keys and spec.mode == "upsert" else ("INSERT IGNORE" in last[1])


def test_plan_files_are_loads_of_their_own(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.json").write_text('[{"id":"%s"}]' % name)
    taken = Recorder()
    load(spark, FEEDS["F53"], str(tmp_path / "*.json"), "unused", 3, target=taken.database())
    loads = {r["load_id"] for r in taken.staged["flight_plan_root_staging"][0]}
    assert len(loads) == 2 and all(n.startswith("import-3-") for n in loads)
    statement = taken.calls[-1][0]
    assert "NOT EXISTS (SELECT 1 FROM `flight_plan_root_loads` l WHERE l.`load_id` = s.`load_id`)" in statement
