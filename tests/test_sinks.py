import importlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ferryline.session import new_dir, shared_dir
from ferryline.sinks import (
    KeyedTable,
    MergeTable,
    append_once,
    copy_table,
    create_if_absent,
    encode_messages,
    export_json,
    jdbc_upsert_statement,
    read_table,
    replace_batch,
    replace_batches,
    route,
)
from ferryline.operators import order_key
from ferryline.sinks import keyed as keyed_sink
from ferryline.sinks.fanout import Child, fan_out
from ferryline.sinks.paths import Files
from ferryline.sources import TableRef
from ferryline.sources.changelog import DELETED

SCHEMA = StructType([StructField("k", LongType()), StructField("v", StringType())])


@pytest.fixture
def keyed(tmp_path):
    return KeyedTable(str(tmp_path / "keyed"), SCHEMA, ("k",), buckets=4)


def frame(spark, *rows, schema="k BIGINT, v STRING, n INT"):
    return spark.createDataFrame(list(rows), schema)


def test_upsert(spark, keyed, rows):
    assert rows(keyed.read(spark)) == []
    keyed.upsert(frame(spark, *[(i, "old", 0) for i in range(20)]), ["n"])
    keyed.upsert(frame(spark, (3, "a", 1), (3, "b", 2), (99, "new", 1)), ["n"])
    want = {i: "old" for i in range(20)} | {3: "b", 99: "new"}
    assert dict(rows(keyed.read(spark))) == want
    keyed.upsert(frame(spark, (3, "a", 1), (3, "b", 2), (99, "new", 1)), ["n"])
    assert dict(rows(keyed.read(spark))) == want
    keyed.upsert(frame(spark), ["n"])
    assert dict(rows(keyed.read(spark))) == want


def test_shuffled_merge_gives_the_same(spark, keyed, rows):
    keyed.upsert(frame(spark, *[(i, "old", 0) for i in range(50)]), ["n"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed.upsert(frame(spark, *[(i, "new", 0) for i in range(25, 75)]), ["n"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert dict(rows(keyed.read(spark))) == {i: "old" if i < 25 else "new" for i in range(75)}


def test_a_merge_gathers_rows_by_directory_at_once(spark, keyed, rows, monkeypatch):
    """Rows are merged where they are written: they are not shuffled again in between."""
    plans, merged = [], keyed_sink.KeyedTable._merged

    def seen(*given):
        plans.append(merged(*given))
        return plans[-1]

    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        keyed.upsert(frame(spark, *[(i, "old", 0) for i in range(200)]), ["n"], across_loads=True)
        monkeypatch.setattr(keyed_sink.KeyedTable, "_merged", seen)
        monkeypatch.setattr(keyed_sink, "SLICE_BYTES", 1, raising=False)
        keyed.upsert(frame(spark, *[(i, "new", 1) for i in range(100, 300)]), ["n"], across_loads=True)
    finally:
        spark.conf.set(name, before)
    want = {i: "old" if i < 100 else "new" for i in range(300)}
    assert dict(rows(keyed.read(spark), "k", "v")) == want
    assert "RebalancePartitions" not in plans[0]._jdf.queryExecution().optimizedPlan().toString()


def test_only_touched_directories_are_rewritten(spark, keyed):
    def written():
        return {r["f"] for r in keyed._read(spark, keyed.path).selectExpr("_metadata.file_path AS f").distinct().collect()}

    keyed.upsert(frame(spark, *[(i, "old", 0) for i in range(40)]), ["n"])
    before = written()
    keyed.upsert(frame(spark, (1, "new", 0)), ["n"])
    assert len(before) == 4 and len(before & written()) == 3
    assert len({f.rpartition("/")[0] for f in written()}) == 4


def test_key_type_does_not_matter(spark, keyed, rows):
    keyed.upsert(frame(spark, (7, "long", 0)), ["n"])
    keyed.upsert(frame(spark, (7, "int", 0), schema="k INT, v STRING, n INT"), ["n"])
    assert rows(keyed.read(spark)) == [(7, "int")]


def test_null_key_fails(spark, keyed):
    with pytest.raises(Exception, match="null key: k"):
        keyed.upsert(frame(spark, (None, "x", 0)), ["n"])


def test_deletes(spark, keyed, rows):
    change = f"k BIGINT, v STRING, n INT, {DELETED} BOOLEAN"
    keyed.apply_changes(frame(spark, (1, "a", 0, False), (2, "b", 0, False), schema=change), ["n"])
    keyed.apply_changes(
        frame(
            spark,
            (1, "a", 1, True), (3, "c", 1, False), (3, "c", 2, True), (8, None, 1, True),
            (2, "b", 1, True), (2, "again", 2, False),
            schema=change,
        ),
        ["n"],
    )
    assert rows(keyed.read(spark)) == [(2, "again")]
    keyed.apply_changes(frame(spark, (2, None, 1, True), schema=change), ["n"])
    assert rows(keyed.read(spark)) == []
    keyed.apply_changes(frame(spark, (4, "d", 1, False), schema=change), ["n"])
    assert rows(keyed.read(spark)) == [(4, "d")]


def test_delete_insert_keeps_repeated_keys(spark, keyed, rows):
    keyed.delete_insert(frame(spark, (1, "a"), (1, "a"), (2, "b"), schema=SCHEMA))
    keyed.delete_insert(frame(spark, (2, "x"), (2, "y"), schema=SCHEMA))
    assert rows(keyed.read(spark)) == [(1, "a"), (1, "a"), (2, "x"), (2, "y")]


def test_driver_lost_before_the_merge_was_written(spark, keyed, rows, monkeypatch):
    keyed.upsert(frame(spark, (1, "old", 0), (5, "old", 0)), ["n"])
    with pytest.raises(Exception, match="lost"):
        keyed.upsert(frame(spark, (1, "new", 0), (9, "new", 0)).selectExpr(
            "k", "IF(k = 9, raise_error('lost'), v) AS v", "n"), ["n"])
    assert rows(keyed.read(spark)) == [(1, "old"), (5, "old")]
    keyed.upsert(frame(spark, (2, "b", 0)), ["n"])
    assert rows(keyed.read(spark)) == [(1, "old"), (2, "b"), (5, "old")]


def test_driver_lost_while_a_merge_was_put_in_place(spark, keyed, rows, monkeypatch):
    """Directories are gone and not there anew: the next write brings them back."""
    keyed.upsert(frame(spark, *[(i, "old", 0) for i in range(20)]), ["n"])

    def lost(df, path):
        files = Files(spark, path)
        of = files.directory_names(path)[0]
        for name in files.directory_names(f"{path}/{of}")[:3]:
            files.delete(f"{path}/{of}/{name}")
        raise OSError("lost")

    monkeypatch.setattr("ferryline.sinks.keyed._overwrite", lost)
    with pytest.raises(OSError, match="lost"):
        keyed.upsert(frame(spark, *[(i, "new", 0) for i in range(10)]), ["n"])
    monkeypatch.undo()
    assert keyed.read(spark).count() < 20
    keyed.upsert(frame(spark, (30, "more", 0)), ["n"])
    want = {i: "new" if i < 10 else "old" for i in range(20)} | {30: "more"}
    assert dict(rows(keyed.read(spark))) == want
    assert not Files(spark, keyed.path).exists(keyed._merging)


CHANGE = f"k BIGINT, v STRING, n INT, {DELETED} BOOLEAN"


@pytest.fixture(params=["few", "many"])
def merging(request, spark):
    """Both ways of merging: changes sent to all tasks, and all rows shuffled."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, before if request.param == "few" else "-1")
    yield request.param
    spark.conf.set(name, before)


def test_order_holds_across_loads(spark, keyed, rows, merging):
    def apply(*changes):
        keyed.apply_changes(frame(spark, *changes, schema=CHANGE), ["n"], across_loads=True)

    apply((1, "five", 5, False), (2, "b", 5, False), (3, "c", 5, False), (4, "d", 5, False))
    apply((1, "four", 4, False), (2, None, 4, True), (3, None, 6, True), (4, "again", 5, False))
    assert rows(keyed.read(spark)) == [(1, "five"), (2, "b"), (4, "again")]
    apply((3, "older than its delete", 5, False), (3, "older still", 1, False), (9, None, 9, True))
    assert rows(keyed.read(spark)) == [(1, "five"), (2, "b"), (4, "again")]
    apply((3, "later", 7, False), (9, "older", 8, False))
    assert rows(keyed.read(spark)) == [(1, "five"), (2, "b"), (3, "later"), (4, "again")]
    apply((3, "later", 7, False), (9, "older", 8, False))
    assert rows(keyed.read(spark)) == [(1, "five"), (2, "b"), (3, "later"), (4, "again")]


def test_loads_without_an_order_count_over_what_is_stored(spark, keyed, rows, merging):
    keyed.upsert(frame(spark, (1, "nine", 9), (2, "nine", 9)), ["n"], across_loads=True)
    keyed.upsert(frame(spark, (1, "plain", 0)), ["n"])
    assert rows(keyed.read(spark)) == [(1, "plain"), (2, "nine")]
    keyed.upsert(frame(spark, (1, "one", 1), (2, "one", 1)), ["n"], across_loads=True)
    assert rows(keyed.read(spark)) == [(1, "one"), (2, "nine")]


def test_random_loads_in_any_order_end_alike(spark, keyed, rows, merging):
    """The same changes in any order of loads, some of them twice, give the same table."""
    import random

    rng = random.Random(4)
    changes = [(k, f"{k}-{n}", n, rng.random() < 0.3) for k in range(40) for n in rng.sample(range(100), 4)]
    last = {k: max((c for c in changes if c[0] == k), key=lambda c: c[2]) for k in range(40)}
    rng.shuffle(changes)
    loads = [changes[i::5] for i in range(5)]
    for load in [*loads, loads[1], loads[3]]:
        keyed.apply_changes(frame(spark, *load, schema=CHANGE), ["n"], across_loads=True)
    assert dict(rows(keyed.read(spark))) == {k: v for k, v, _, deleted in last.values() if not deleted}


def test_deleted_keys_can_be_forgotten(spark, keyed, rows, tmp_path):
    keyed.apply_changes(frame(spark, (1, "a", 1, False), (2, None, 5, True), schema=CHANGE), ["n"], across_loads=True)
    assert keyed.stored(spark).count() == 2
    again = keyed.rebucketed(spark, str(tmp_path / "all"), 2)
    again.upsert(frame(spark, (1, "old", 0), (2, "old", 4)), ["n"], across_loads=True)
    assert rows(again.read(spark)) == [(1, "a")]
    short = keyed.rebucketed(spark, str(tmp_path / "short"), 2, keep_deleted=False)
    short.upsert(frame(spark, (1, "old", 0), (2, "old", 4)), ["n"], across_loads=True)
    assert rows(short.read(spark)) == [(1, "a"), (2, "old")]


def test_order_key_compares_like_its_columns(spark):
    import random

    rng = random.Random(8)
    whole = [None, -(2**63), -1, 0, 1, 255, 256, 2**63 - 1]
    texts = [None, "", "a", "a\x01", "ab", "b", "é"]
    times = [None, "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "2024-05-01 10:00:00.5"]
    made = [(rng.choice(times), rng.choice(texts), rng.choice(whole)) for _ in range(300)]
    df = spark.createDataFrame(made, "t STRING, s STRING, n BIGINT").selectExpr(
        "CAST(t AS TIMESTAMP) AS t", "s", "n", "CAST(t AS TIMESTAMP_NTZ) AS l", "CAST(t AS DATE) AS d")
    for sequence in (["t", "s", "n"], ["s", "n"], ["n"], ["l", "n"], ["d", "s"]):
        found = df.select(*sequence, order_key(df.schema, sequence).alias("key")).collect()
        by_key = sorted(found, key=lambda r: bytes(r["key"]))
        want = sorted(found, key=lambda r: [(r[c] is not None, r[c] if r[c] is not None else 0) for c in sequence])
        assert [tuple(r)[:-1] for r in by_key] == [tuple(r)[:-1] for r in want]
    with pytest.raises(TypeError, match="double"):
        order_key(spark.range(1).selectExpr("1.5D AS x").schema, ["x"])


def test_shuffled_merge_of_repeated_keys(spark, keyed, rows):
    """Many rows of few keys, and the way for changes too large to send."""
    keyed.delete_insert(frame(spark, *[(i % 3, "old") for i in range(30)], schema=SCHEMA))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed.delete_insert(frame(spark, *[(2, "new")] * 7, schema=SCHEMA))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert rows(keyed.read(spark)) == [(0, "old")] * 10 + [(1, "old")] * 10 + [(2, "new")] * 7


def test_changes_may_come_from_the_table_itself(spark, keyed, rows):
    keyed.upsert(frame(spark, (1, "a", 0), (2, "b", 0)), ["n"])
    again = keyed.read(spark).selectExpr("k + 1 AS k", "upper(v) AS v")
    keyed.upsert(again, [])
    assert rows(keyed.read(spark)) == [(1, "a"), (2, "A"), (3, "B")]


def test_a_table_knows_its_number_of_buckets(spark, keyed, rows):
    keyed.upsert(frame(spark, *[(i, "a", 0) for i in range(20)]), ["n"])
    other = KeyedTable(keyed.path, SCHEMA, ("k",), buckets=8)
    other.upsert(frame(spark, (3, "b", 0)), ["n"])
    assert dict(rows(keyed.read(spark))) == {i: "b" if i == 3 else "a" for i in range(20)}


def test_small_merges_do_not_shuffle_stored_rows(spark, keyed):
    keyed.upsert(frame(spark, *[(i, "a", 0) for i in range(20)]), ["n"])
    changes = frame(spark, (1, "b", 0)).selectExpr(
        "k", "v", "CAST(NULL AS BINARY) AS _order", f"false AS {DELETED}", "4 AS _of", "0 AS _bucket").persist()
    changes.count()

    def plan():
        merged = keyed._merged(changes, [0, 1, 2, 3], unique=True)
        return merged._jdf.queryExecution().executedPlan().toString()

    small = plan()
    assert "hashpartitioning" not in small and "SortMergeJoin" not in small
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Join" not in large and "Window" in large
    changes.unpersist()


def test_one_key_with_a_third_of_all_changes(spark, keyed, rows):
    df = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "CAST(id AS STRING) AS v", "id AS n"
    )
    keyed.upsert(df, ["n"])
    stored = keyed.read(spark)
    assert stored.count() == 20_001
    assert rows(stored.where("k = 0")) == [(0, "29997")]


def test_batches(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    schema = StructType.fromDDL("v INT, batch_number STRING")
    df = spark.createDataFrame([(1, "01"), (2, "01"), (3, "02"), (4, "03")], schema)
    replace_batches(df, path)
    replace_batches(df.where("v = 3").selectExpr("v * 10 AS v", "batch_number"), path, batches=["02", "03"])
    replace_batch(spark.createDataFrame([(7,)], "v INT"), path, "01")
    assert rows(read_table(spark, path, schema)) == [(30, "02"), (7, "01")]


def test_fan_out_of_files_shuffles_no_rows(spark, tmp_path, rows, monkeypatch):
    """Rows of file loads are written where they are read, and only loads there before are looked up."""
    roots = spark.range(8).selectExpr("id", "CAST(id % 4 AS STRING) AS load_id", "array(id, -id) AS n").cache()
    children = [Child("child", lambda d: d.selectExpr("load_id", "explode(n) AS n").where("n <> 0"))]
    root = Child("root", lambda d: d.select("id", "load_id"))
    hinted, written = [], []
    append = importlib.import_module("ferryline.sinks.append")
    hint, write = type(roots).hint, append._overwrite_partitions
    monkeypatch.setattr(type(roots), "hint", lambda df, *a: hinted.append(a) or hint(df, *a))
    monkeypatch.setattr(append, "_overwrite_partitions", lambda df, *a: written.append(a) or write(df, *a))
    for _ in range(2):
        fan_out(roots, children, root, str(tmp_path))
    assert not hinted and len(written) == 4
    fan_out(roots.where("id <> 0 OR load_id <> '0'").where("load_id <> '1'"), children, root, str(tmp_path))
    found = rows(spark.read.parquet(f"{tmp_path}/child"), "n")
    assert found == sorted([(n,) for i in range(1, 8) for n in (i, -i)], key=repr)
    # A load that has no rows for a table any more is emptied there.
    fan_out(roots.where("load_id = '2'").selectExpr("id", "load_id", "array(0L) AS n"), children, root, str(tmp_path))
    found = rows(spark.read.parquet(f"{tmp_path}/child"), "n")
    assert found == sorted([(n,) for i in range(1, 8) if i % 4 != 2 for n in (i, -i)], key=repr)


def test_append_once(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,), (1,)], "v INT")
    for load in (0, 1, 1):
        append_once(df, path, load)
    assert rows(read_table(spark, path, df.schema)) == [(1,)] * 4
    append_once(df.limit(0), path, 1)
    assert rows(read_table(spark, path, df.schema)) == [(1,)] * 2


def test_create_if_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    assert create_if_absent(spark, path, SCHEMA)
    assert not create_if_absent(spark, path, SCHEMA)
    assert spark.read.parquet(path).schema.names == ["k", "v"]


def test_messages_and_export(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], SCHEMA)
    assert json.loads(encode_messages(df).first()["value"]) == {"k": 1, "v": None}
    path = export_json(df, str(tmp_path), "people", 123)
    assert path.endswith("people_123")
    assert spark.read.schema(SCHEMA).json(path).collect() == df.collect()


def test_route():
    assert route("a", {"a": "x"}) == "x"
    with pytest.raises(ValueError):
        route("b", {"a": "x"})


def test_upsert_statement():
    text = jdbc_upsert_statement("t", "s", ["id", "a"], ["id"])
    assert text == (
        "INSERT INTO `t` (`id`, `a`) SELECT `id`, `a` FROM `s` "
        "ON DUPLICATE KEY UPDATE `a` = VALUES(`a`)"
    )


def test_merge_needs_a_table_format_with_merge(spark, tmp_path):
    """No such format is installed, so this only shows that the statement resolves."""
    spark.sql(f"CREATE TABLE merged (k BIGINT, v STRING) USING parquet LOCATION '{tmp_path}/m'")
    try:
        target = MergeTable("merged", SCHEMA, ("k",))
        assert target.read(spark).columns == ["k", "v"]
        with pytest.raises(Exception, match="MERGE"):
            target.upsert(frame(spark, (1, "a", 0)), ["n"])
        marked = frame(spark, (1, "a", 0, True), schema=f"k BIGINT, v STRING, n INT, {DELETED} BOOLEAN")
        with pytest.raises(Exception, match="MERGE"):
            target.apply_changes(marked, ["n"])
        spark.sql(f"ALTER TABLE merged ADD COLUMNS (_order BINARY, {DELETED} BOOLEAN)")
        ordered = MergeTable("merged", SCHEMA, ("k",), ordered=True)
        for write in (ordered.upsert, ordered.apply_changes):
            with pytest.raises(Exception, match="MERGE"):
                write(marked, ["n"], across_loads=True)
    finally:
        spark.sql("DROP TABLE merged")


def test_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named.rstrip("/")
    assert new_dir(spark, "x").startswith(shared_dir(spark))


def test_directories_from_the_size_of_the_first_load(spark, tmp_path, rows):
    small = KeyedTable(str(tmp_path / "small"), SCHEMA, ("k",), buckets=None)
    assert rows(small.read(spark)) == []
    path = str(tmp_path / "in")
    frame(spark, *[(i, "a", 0) for i in range(20)]).write.parquet(path)
    small.upsert(spark.read.parquet(path), ["n"])
    assert small.directories(spark) == 1
    wide = small.rebucketed(spark, str(tmp_path / "wide"), 8)
    assert wide.directories(spark) == 8
    assert rows(wide.read(spark)) == rows(small.read(spark))


def test_directories_of_a_joined_load(spark, tmp_path):
    """Spark takes a join for as large as both sides multiplied; that is no size of a load."""
    path = str(tmp_path / "in")
    spark.range(200_000).selectExpr("id AS k", "uuid() AS v", "1 AS n").write.parquet(path)
    one, other = spark.read.parquet(path), spark.read.parquet(path).select("k", F.upper("v").alias("w"))
    table = KeyedTable(str(tmp_path / "joined"), SCHEMA, ("k",), buckets=None)
    table.upsert(one.join(other, "k").where("k < 50"), ["n"])
    assert table.directories(spark) == 1


def test_copies_under_a_declared_key_are_not_reduced(spark, tmp_path, monkeypatch):
    """A first copy is one pass: no window over the key, no shuffle but that of the write."""
    spark.range(100).write.parquet(str(tmp_path / "in"))
    plans = []
    real = keyed_sink._overwrite

    def seen(df, path):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, path)

    monkeypatch.setattr(keyed_sink, "_overwrite", seen)
    source = TableRef("parquet", str(tmp_path / "in"), keys=("id",))
    assert copy_table(spark, source, str(tmp_path / "out")).count() == 100
    assert "Window" not in plans[0] and "Sort" not in plans[0]
