"""Streaming steps that keep state."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from ferryline.sinks import append_once, read_table
from ferryline.streaming import close_after_end, file_stream, land, once

ROWS = "k STRING, n BIGINT, what STRING"


def put(spark, path, *rows, schema=ROWS):
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)


class Closing:
    """A stream of keyed rows into a table, started and stopped at will."""

    def __init__(self, spark, tmp_path, grace):
        self.spark, self.grace = spark, grace
        self.source, self.out, self.check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def start(self):
        stream = file_stream(self.spark, self.source, ROWS)
        closing = close_after_end(stream, "k", F.col("what") == "end", self.grace)
        write = lambda rows, batch_id: append_once(rows, self.out, batch_id)
        return land(closing, write, self.check, "SCHEDULED", "0 seconds")

    def found(self):
        schema = f"{ROWS}, state STRING, load_id BIGINT"
        rows = self.spark.read.schema(schema).parquet(self.out).collect()
        return sorted((r["k"], r["n"], r["state"]) for r in rows if r["n"] is not None), {
            r["k"]: r["load_id"] for r in rows if r["state"] == "closed"
        }

    def wait_for(self, *closed, rows=0, seconds=60):
        """Until some keys are closed and so many rows have passed; such a stream is never idle."""
        last = time.monotonic() + seconds
        while time.monotonic() < last:
            try:
                passed, done = self.found()
                if set(closed) <= set(done) and len(passed) >= rows:
                    return
            except Exception:  # nothing is written yet
                pass
            time.sleep(0.5)
        raise AssertionError(f"{closed} are not closed, or rows are missing")


def test_each_key_closes_after_its_own_grace(spark, tmp_path):
    run = Closing(spark, tmp_path, grace=1.5)
    big = 2**60 + 1  # would change if it went through a floating-point number
    put(spark, run.source, ("a", big, "row"), ("a", None, "end"), ("b", 2, "row"), ("c", 3, "row"))
    query = run.start()
    try:
        run.wait_for("a")
        put(spark, run.source, ("a", 10, "row"), ("b", 11, "row"), ("b", None, "end"), ("b", 12, "row"))
        run.wait_for("a", "b")
        put(spark, run.source, ("a", 20, "row"), ("b", 21, "row"), ("c", 22, "row"), ("a", None, "end"))
        run.wait_for(rows=9)
    finally:
        query.stop()
    rows, closed = run.found()
    assert rows == [
        ("a", 10, "late"), ("a", 20, "late"), ("a", big, "open"),
        ("b", 2, "open"), ("b", 11, "open"), ("b", 12, "open"), ("b", 21, "late"),
        ("c", 3, "open"), ("c", 22, "open"),
    ]
    assert set(closed) == {"a", "b"} and closed["a"] < closed["b"]


def test_timers_and_closed_keys_survive_a_restart(spark, tmp_path):
    run = Closing(spark, tmp_path, grace=3)
    put(spark, run.source, ("a", 1, "row"), ("a", None, "end"), ("b", 2, "row"))
    query = run.start()
    run.wait_for(rows=2)
    query.stop()
    assert run.found() == ([("a", 1, "open"), ("b", 2, "open")], {})
    time.sleep(3)
    query = run.start()
    run.wait_for("a")
    query.stop()
    put(spark, run.source, ("a", 3, "row"), ("b", 4, "row"))
    query = run.start()
    run.wait_for(rows=4)
    query.stop()
    assert run.found()[0] == [("a", 1, "open"), ("a", 3, "late"), ("b", 2, "open"), ("b", 4, "open")]


def test_no_group_holds_all_rows_of_a_key(spark, tmp_path):
    """A worker holds what a group gives, so a hot key is many groups; it still closes once."""
    run = Closing(spark, tmp_path, grace=1)
    rows = spark.range(20_000).selectExpr("'a' AS k", "id AS n", "'row' AS what")
    rows.unionByName(spark.createDataFrame([("a", None, "end")], ROWS)).coalesce(1).write.parquet(run.source)
    query = run.start()
    try:
        run.wait_for("a", rows=20_000)
    finally:
        query.stop()
    found = run.found()[0]
    assert found == sorted(("a", n, "open") for n in range(20_000))
    table = spark.read.parquet(run.out)
    assert table.where("state = 'closed'").count() == 1
    states = spark.read.format("statestore").option("stateVarName", "closing").load(run.check)
    assert states.where("key.k = 'a'").count() > 100


TIMED = "id BIGINT, v STRING, timestamp TIMESTAMP"


def test_repeated_rows_pass_once(spark, tmp_path, rows):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def at(minute):
        return datetime.datetime(2024, 5, 1, 10, minute)

    def run(*sent):
        put(spark, source, *sent, schema=TIMED)
        stream = once(file_stream(spark, source, TIMED), ["id"], within="10 minutes")
        query = land(stream, lambda b, i: append_once(b, out, i), check)
        query.awaitTermination()
        return query

    run((1, "first", at(0)), (1, "twice in a batch", at(1)), (2, "b", at(2)), (None, "no key", at(2)))
    run((2, "again", at(2)), (1, "again, later", at(5)), (3, "late but new", at(1)), (None, "no key", at(3)))
    run((4, "moves the time on", at(40)))
    query = run((5, "new", at(41)), (6, "too old", at(3)))
    stored = read_table(spark, out, spark.createDataFrame([], TIMED).schema)
    first = {r["id"]: r["v"] for r in stored.collect()}
    assert set(first) == {1, 2, 3, 4, 5, None} and stored.count() == 6
    assert first[2] == "b" and first[3] == "late but new"
    kept = [op.numRowsTotal for p in query.recentProgress for op in p.stateOperators]
    assert kept[-1] <= 2  # the keys of the first hour are gone


@pytest.mark.parametrize("sends", [2, 3])
def test_state_holds_only_the_keys_of_the_time(spark, tmp_path, sends):
    """Each send is an hour of its own and is delivered twice."""
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    most = []
    for hour in range(sends):
        day = datetime.datetime(2024, 5, 1, 5 + hour)
        rows = [(1000 * hour + i, "x", day + datetime.timedelta(seconds=i)) for i in range(100)]
        for _ in range(2):
            put(spark, source, *rows, schema=TIMED)
            stream = once(file_stream(spark, source, TIMED), ["id"], within="5 minutes")
            query = land(stream, lambda b, i: append_once(b, out, i), check)
            query.awaitTermination()
            most.append(query.lastProgress.stateOperators[0].numRowsTotal)
    assert spark.read.parquet(out).select("id").distinct().count() == 100 * sends
    assert spark.read.parquet(out).count() == 100 * sends
    assert most[-1] <= 100
