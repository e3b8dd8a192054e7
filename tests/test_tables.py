"""Inputs made of lists of rows: the same lists either way, and none gathered beside the others."""

import pytest
from pyspark.sql import functions as F

from ferryline.suite import feeds
from ferryline.suite.tables import blocks, long_blocks

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, at TIMESTAMP, d DATE, event_type STRING, value DOUBLE"


def events(spark):
    """Rows whose key is missing, comes twice or is negative, with nulls and NaN elsewhere."""
    made = spark.range(60).select(
        F.when(F.col("id") % 13 != 5, F.col("id") % 40 - 3).alias("event_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:11.172425' + make_interval(0, 0, 0, 0, 0, id)").alias("ts"),
        F.timestamp_micros(F.col("id") * 1_000_003).alias("at"),
        F.when(F.col("id") % 4 != 1, F.date_from_unix_date(F.col("id").cast("int"))).alias("d"),
        F.when(F.col("id") % 3 == 0, "click").when(F.col("id") % 3 == 1, "ä\"}").alias("event_type"),
        F.expr("CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN double('NaN') ELSE 60 - id END").alias("value"),
    )
    return made.unionByName(made.where("event_id % 7 = 0"))


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_long_blocks_are_blocks(spark, size):
    rows = events(spark).select(*[word.split()[0] for word in EVENTS.split(", ")])
    want, found = blocks(rows, "event_id", size), long_blocks(rows, "event_id", size)
    assert found.dtypes == want.dtypes
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
    encoded = [sorted(map(repr, df.select("block", F.to_json("records")).collect())) for df in (found, want)]
    assert encoded[0] == encoded[1]
    assert long_blocks(rows.limit(0), "event_id", size).collect() == []


def test_personnel_files_are_made_one_at_a_time(spark, tmp_path, monkeypatch):
    """Spark's aggregate would hold 128 lists of 5000 wide rows in each task."""
    written = []

    def keep(texts, path):
        written.append(texts)
        return path

    events(spark).where("event_id >= 0").drop("at", "d").write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(feeds, "write_texts", keep)
    monkeypatch.setattr(feeds, "load", lambda *_: None)
    feeds.personnel_file(spark, str(tmp_path))
    assert len(written) == 2
    for texts in written:
        assert texts.count() == 1
        assert "ObjectHashAggregate" not in texts._jdf.queryExecution().executedPlan().toString()
