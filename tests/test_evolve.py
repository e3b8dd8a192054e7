import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ferryline.operators import time_range
from ferryline.sinks import SchemaChanged, append, copy_table, evolved, ordered_by
from ferryline.sinks.evolve import declared_schema
from ferryline.sources import TableRef


def schema(spark, text):
    return spark.range(0).select(F.from_json(F.lit("{}"), text).alias("s")).select("s.*").schema


def state(spark, folder, select, n=5, keys=()):
    """A source in its next state, and where it lies."""
    path = f"{folder}/source-{len(list(folder.iterdir())):03d}"
    spark.range(n).selectExpr(*select).write.parquet(path)
    return TableRef("parquet", path, keys=keys)


WIDENED = [
    ("tinyint", "smallint", 7, 7),
    ("tinyint", "int", 7, 7),
    ("smallint", "bigint", 7, 7),
    ("int", "bigint", 7, 7),
    ("int", "double", 7, 7.0),
    ("smallint", "double", 7, 7.0),
    ("tinyint", "double", 7, 7.0),
    ("float", "double", 7, 7.0),
    ("decimal(5,2)", "decimal(9,2)", 7, Decimal("7.00")),
    ("decimal(5,2)", "decimal(18,4)", 7, Decimal("7.0000")),
    ("decimal(9,1)", "decimal(30,5)", 7, Decimal("7.00000")),
    ("decimal(18,3)", "decimal(38,6)", 7, Decimal("7.000000")),
    ("decimal(20,3)", "decimal(38,6)", 7, Decimal("7.000000")),
]


@pytest.mark.parametrize("keys", [(), ("id",)], ids=["plain", "keyed"])
@pytest.mark.parametrize("narrow, wide, value, read", WIDENED)
def test_widened(spark, tmp_path, keys, narrow, wide, value, read):
    """Old files are read in the new type, in either order of the two types."""
    for first, second in ((narrow, wide), (wide, narrow)):
        out = str(tmp_path / f"out-{first}")
        copy_table(spark, state(spark, tmp_path, ["id", f"CAST({value} AS {first}) AS v"], keys=keys), out)
        rest = state(spark, tmp_path, ["id + 3 AS id", f"CAST({value} + 1 AS {second}) AS v"], keys=keys)
        copy = copy_table(spark, rest, out)
        assert copy.schema["v"].dataType.simpleString() == wide
        found = sorted(tuple(r) for r in copy.collect())
        one = type(read)(1)
        old = range(3) if keys else range(5)
        assert found == sorted([(i, read) for i in old] + [(i, read + one) for i in range(3, 8)])


def test_dates_become_timestamps(spark, tmp_path):
    out = str(tmp_path / "out")
    copy_table(spark, state(spark, tmp_path, ["DATE'2024-02-29' AS v"], 1), out)
    copy = copy_table(spark, state(spark, tmp_path, ["TIMESTAMP_NTZ'2024-03-01 01:02:03' AS v"], 1), out)
    assert sorted(r.v for r in copy.collect()) == [
        datetime.datetime(2024, 2, 29), datetime.datetime(2024, 3, 1, 1, 2, 3)
    ]


@pytest.mark.parametrize("keys", [(), ("id",)], ids=["plain", "keyed"])
def test_added_and_dropped(spark, tmp_path, rows, keys):
    out = str(tmp_path / "out")
    copy_table(spark, state(spark, tmp_path, ["id", "'a' AS a"], 2, keys), out)
    copy_table(spark, state(spark, tmp_path, ["'b' AS b", "id + 2 AS ID"], 2, keys), out)
    copy = copy_table(spark, state(spark, tmp_path, ["id + 4 AS id"], 1, keys), out)
    assert copy.columns == ["id", "a", "b"]
    want = [(0, "a", None), (1, "a", None), (2, None, "b"), (3, None, "b"), (4, None, None)]
    assert rows(copy) == want
    # A column that comes back fills the old one again; an empty state adds its columns.
    copy = copy_table(spark, state(spark, tmp_path, ["id + 5 AS id", "'c' AS a"], 1, keys), out)
    assert rows(copy) == want + [(5, "c", None)]
    copy = copy_table(spark, state(spark, tmp_path, ["id", "MAP('x', 1) AS m"], 0, keys), out)
    assert copy.columns == ["id", "a", "b", "m"] and copy.count() == 6


@pytest.mark.parametrize(
    "stored, found, named",
    [
        ("v STRING", "v BIGINT", "v changed from string to bigint"),
        ("v BIGINT", "v DOUBLE", "v changed from bigint to double"),
        ("v DECIMAL(9,2)", "v DECIMAL(9,3)", "v changed"),
        ("v TIMESTAMP", "v TIMESTAMP_NTZ", "v changed"),
        ("v STRUCT<a: INT>", "v STRUCT<a: INT, b: INT>", "v changed"),
        ("v ARRAY<INT>", "v ARRAY<BIGINT>", "v changed"),
    ],
)
def test_other_changes_fail_by_name(spark, stored, found, named):
    with pytest.raises(SchemaChanged, match=named):
        evolved(schema(spark, stored), schema(spark, found))


def test_keys_keep_their_type(spark):
    before = schema(spark, "k INT, v INT")
    for found, named in (("k BIGINT, v INT", "key k changed"), ("v INT", "key k is missing")):
        with pytest.raises(SchemaChanged, match=named):
            evolved(before, schema(spark, found), ["k"])
    with pytest.raises(SchemaChanged, match="key v changed from no column"):
        evolved(schema(spark, "k INT"), before, ["v"])


def test_a_refused_copy_changes_nothing(spark, tmp_path, rows):
    out = str(tmp_path / "out")
    before = rows(copy_table(spark, state(spark, tmp_path, ["id", "'a' AS a"]), out))
    with pytest.raises(SchemaChanged):
        copy_table(spark, state(spark, tmp_path, ["id", "1 AS a", "2 AS b"]), out)
    assert declared_schema(spark, out).names == ["id", "a"]
    assert rows(spark.read.schema(declared_schema(spark, out)).parquet(out)) == before


def test_a_table_written_before_it_had_a_declared_schema(spark, tmp_path, rows):
    out = str(tmp_path / "out")
    append(spark.range(2).selectExpr("CAST(id AS INT) AS id", "'a' AS a"), out)
    copy = copy_table(spark, state(spark, tmp_path, ["id + 2 AS id"], 1), out)
    assert rows(copy) == [(0, "a"), (1, "a"), (2, None)]


# Layout


def rows_scanned(df):
    """Rows that left the file scan when ``df`` was run."""
    df._jdf.queryExecution().executedPlan().executeCollect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    leaf = plan.collectLeaves().head()
    return int(leaf.metrics().apply("numOutputRows").value())


@pytest.fixture
def shuffled(spark):
    seconds = F.lit(1_700_000_000) + F.col("id")
    times = spark.range(40_000).withColumns({"t": F.timestamp_seconds(seconds), "ms": seconds * 1000})
    return times.repartition(8, F.xxhash64("id"))


@pytest.mark.parametrize("column", ["t", "ms"])
def test_a_cut_reads_few_rows(spark, tmp_path, shuffled, column):
    append(shuffled, str(tmp_path / "plain"))
    append(ordered_by(shuffled, column, 8), str(tmp_path / "ordered"))
    read = {}
    for name in ("plain", "ordered"):
        table = spark.read.parquet(str(tmp_path / name))
        cut = time_range(table, column, 1_700_000_000_000, 1_700_000_999_000)
        assert cut.count() == 1000
        read[name] = rows_scanned(cut)
    assert read["plain"] == 40_000
    assert read["ordered"] < 10_000


def test_one_value_is_split_over_tasks(spark, shuffled):
    hot = shuffled.withColumn("t", F.when(F.col("id") % 3 > 0, F.col("t")))
    dealt = ordered_by(hot.withColumn("m", F.create_map("id", "id")), "t", 8)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 2 * 40_000 / 8


def test_odd_tables_are_laid_out(spark, tmp_path, rows):
    for n, df in enumerate((
        spark.range(0).withColumn("t", F.lit(None).cast("timestamp")),
        spark.createDataFrame([(None, 1), (3, 2), (3, 2), (1, None)], "`a.b` INT, c INT"),
    )):
        path = str(tmp_path / str(n))
        append(ordered_by(df, df.columns[0] if n else "t"), path)
        assert rows(spark.read.parquet(path)) == rows(df)
