import pytest
from pyspark.sql import functions as F

from ferryline import functions as fn
from ferryline import operators as op
from ferryline.sources.changelog import DELETED


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_zones(spark):
    local = F.lit("2025-05-13 00:40:00").cast("timestamp_ntz")
    ms = value(spark, fn.local_to_epoch_ms(local, "Asia/Shanghai"))
    assert ms == 1747068000000
    back = value(spark, fn.epoch_ms_to_local(F.lit(1747068800000), "Asia/Shanghai"))
    assert back.isoformat() == "2025-05-13T00:53:20"
    assert value(spark, fn.local_to_epoch_ms(F.lit(None).cast("timestamp_ntz"), "Asia/Shanghai")) is None


def test_seconds_and_dates(spark):
    date = F.lit("1970-01-02").cast("date")
    assert value(spark, fn.date_time_to_epoch_seconds(date, F.lit("00:00:01.900"))) == 86401
    assert value(spark, fn.leading_date(F.lit("20250303_x_01"))).isoformat() == "2025-03-03"


def test_time_of_day(spark):
    assert value(spark, fn.time_of_day_text(fn.time_of_day(F.lit("01:02:03.4")))) == "01:02:03.400"
    assert value(spark, fn.time_of_day_text(fn.time_of_day(F.lit("01:02:03")))) == "01:02:03.000"
    assert value(spark, fn.time_of_day_seconds(fn.time_of_day(F.lit("01:02:03.999")))) == "01:02:03"
    assert value(spark, fn.time_of_day(F.lit(None).cast("string"))) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, fn.time_of_day(F.lit("24:00:00")))


def test_numerals(spark):
    assert [value(spark, fn.chinese_numeral(F.lit(n))) for n in (1, 10, 11, 20)] == ["一", "十", "十一", "二十"]
    assert value(spark, fn.chinese_numeral(F.lit(None).cast("int"))) is None
    for number in (0, 21):
        with pytest.raises(Exception, match="not in 1-20"):
            value(spark, fn.chinese_numeral(F.lit(number)))


def test_casts(spark, rows):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v STRING")
    assert rows(op.cast_columns(df, {"v": "double"}, strict=False)) == [(1.5,), (None,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        op.cast_columns(df, {"v": "double"}).collect()


def test_chain_and_stamp(spark, rows):
    df = op.chain(spark.range(1), [lambda d: d.withColumn("a", F.lit(1)), None])
    stamped = op.stamp(df, {"import_id": "bigint"}, import_id=None, batch_number="b")
    assert rows(stamped) == [(0, 1, None, "b")]
    assert dict(stamped.dtypes)["import_id"] == "bigint"
    assert op.chain(df, []) is df


def test_nesting(spark, rows):
    df = spark.createDataFrame(
        [(1, (5,), [(1,), None]), (2, None, []), (3, (6,), None)],
        "id INT, head STRUCT<x: INT>, kids ARRAY<STRUCT<k: INT>>",
    )
    assert rows(op.struct_rows(df, "head", {"root": "id"})) == [(1, 5), (3, 6)]
    assert rows(op.explode_children(df, "kids", {"root": "id"})) == [(1, 1)]


@pytest.mark.parametrize("kind", ["bigint", "timestamp", "timestamp_ntz"])
def test_time_range_includes_both_ends(spark, rows, kind):
    df = spark.createDataFrame([(i,) for i in (999, 1000, 1500, 2000, 2001)], "ms BIGINT")
    column = F.col("ms") if kind == "bigint" else F.timestamp_millis("ms").cast(kind)
    got = op.time_range(df.withColumn("t", column), "t", 1000, 2000)
    assert rows(got, "ms") == [(1000,), (1500,), (2000,)]


def test_time_range_counts_the_last_millisecond_in_full(spark):
    df = spark.createDataFrame([("1970-01-01 00:00:02.000999",)], "t STRING")
    df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert op.time_range(df, "t", 1000, 2000).count() == 1
    assert op.time_range(df, "t", 1000, 1999).count() == 0


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr(
        "id AS ms", "CAST(timestamp_millis(id) AS TIMESTAMP_NTZ) AS ts", "id AS other"
    ).write.parquet(path)
    df = spark.read.parquet(path)
    by_ms = plan(op.time_range(df, "ms", 2, 5).select("ms"))
    assert "GreaterThanOrEqual(ms,2)" in by_ms and "LessThanOrEqual(ms,5)" in by_ms
    by_time = plan(op.time_range(df, "ts", 2, 5).select("ts"))
    assert "GreaterThanOrEqual(ts," in by_time and "LessThan(ts," in by_time
    assert "ReadSchema: struct<ts:timestamp_ntz>" in by_time
    assert "EqualTo(ms,3)" in plan(op.key_equals(df, "ms", 3))


def test_column_of_a_label(spark):
    df = spark.createDataFrame(
        [("x", "c0", 0), ("time", "c2", 2), ("time", "c1", 1)], "name STRING, code STRING, position INT"
    )
    assert op.resolve_column(df, "time") == "c1"
    assert op.resolve_column(df, "none") is None
    assert op.optional_time_range(df, None, 0, 1) is df


def test_control_rows(spark, rows):
    df = spark.createDataFrame([("END_1",), ("a END_1",), (None,)], "k STRING")
    assert rows(op.drop_control_rows(df, "k", "END_")) == [("a END_1",), (None,)]
    assert op.drop_control_rows(df, "k", "END_", run_once=False).count() == 3


def test_first_child(spark, rows):
    parents = spark.createDataFrame([(1,), (2,)], "id INT")
    children = spark.createDataFrame([(1, [("a",), ("b",)])], "id INT, kids ARRAY<STRUCT<n: STRING>>")
    found = op.first_child(parents, children, ["id"], "kids", missing="skip")
    assert rows(found) == [(1, "a")]
    with pytest.raises(Exception, match="nothing landed"):
        op.first_child(parents, children, ["id"], "kids").collect()
    with pytest.raises(Exception, match="nothing landed"):
        op.parent_children(parents, children, ["id"]).select("id").collect()
    empty = spark.createDataFrame([(1, [])], "id INT, kids ARRAY<STRUCT<n: STRING>>")
    with pytest.raises(Exception, match="empty child list"):
        op.first_child(parents, empty, ["id"], "kids").collect()


def test_new_keys(spark, rows):
    remote = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k STRING")
    loaded = spark.createDataFrame([("a",), ("a",), (None,)], "k STRING")
    assert rows(op.new_keys_only(remote, loaded, ["k"])) == [("b",), ("b",), (None,)]


CHANGES = [(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "x", 1), (2, "y", 1)]


def test_latest_per_key_breaks_ties_by_content(spark, rows):
    for parts in (1, 5):
        df = spark.createDataFrame(CHANGES, "k INT, v STRING, n INT").repartition(parts)
        assert rows(op.latest_per_key(df, ["k"], ["n"])) == [(1, "b", 3), (2, "y", 1)]


def test_latest_per_key_reduces_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(CHANGES, "k INT, v STRING, n INT").write.parquet(path)
    text = plan(op.latest_per_key(spark.read.parquet(path), ["k"], ["n"]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_frames_of_changes(spark, rows):
    target = spark.createDataFrame([(1, "o"), (3, "o"), (4, "o")], "k INT, v STRING")
    changes = spark.createDataFrame(CHANGES, "k INT, v STRING, n INT")
    assert rows(op.upsert(target, changes, ["k"], ["n"])) == [(1, "b"), (2, "y"), (3, "o"), (4, "o")]
    marked = spark.createDataFrame(
        [(1, "z", 1, True), (5, "n", 1, False), (5, "n", 2, True), (9, None, 1, True), (4, "u", 7, False)],
        f"k INT, v STRING, n INT, {DELETED} BOOLEAN",
    )
    assert rows(op.apply_changes(target, marked, ["k"], ["n"])) == [(3, "o"), (4, "u")]
    several = spark.createDataFrame([(1, "p"), (1, "q")], "k INT, v STRING")
    assert rows(op.delete_insert(target, several, ["k"])) == [(1, "p"), (1, "q"), (3, "o"), (4, "o")]


def test_time_range_of_local_times(spark, rows):
    """Zone-less times are those of the zone given; the bounds are converted, not the column."""
    df = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2024-01-10 07:59:59.999'), "
        "(2, TIMESTAMP_NTZ'2024-01-10 08:00:00'), (3, TIMESTAMP_NTZ'2024-01-10 09:00:00') AS t(i, at)"
    )
    start = 1704844800000  # 2024-01-10 00:00 UTC, 08:00 in Shanghai
    found = op.time_range(df, "at", start, start + 3_600_000 - 1, "Asia/Shanghai")
    assert rows(found, "i") == [(2,)]
    assert rows(op.time_range(df, "at", start, start + 8 * 3_600_000), "i") == [(1,), (2,)]


def test_latest_without_tie_break_bears_maps(spark, rows):
    df = spark.sql("SELECT 1 AS k, s, map('s', s) AS m FROM VALUES (1), (2) AS t(s)")
    (row,) = op.latest_per_key(df, ["k"], ["s"], tie_break=False).collect()
    assert row.m == {"s": 2}
