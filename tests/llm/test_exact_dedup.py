import re
from collections import defaultdict

from pyspark.sql import functions as F

from ferryline.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        least = min(known, default=None)
        out += [(i, least, len(ids)) for i in ids]
    return sorted(out, key=repr)


def test_groups_equal_brute_force(spark, odd, documents):
    for df in (odd, documents):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        found = exact_dedup.groups(df).collect()
        got = sorted([(r.doc_id, r.keep_id, r.group_size) for r in found], key=repr)
        assert got == brute(rows)


def test_one_row_of_each_group_is_kept(odd):
    kept = exact_dedup.groups(odd).where("kept").collect()
    assert len(kept) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_kept_rows_keep_all_columns(odd):
    kept = exact_dedup.deduplicated(odd)
    assert kept.columns == odd.columns
    before = {tuple(r) for r in odd.collect()}
    rows = [tuple(r) for r in kept.collect()]
    assert set(rows) <= before
    assert len(rows) == exact_dedup.groups(odd).where("kept").count()


def test_copies_over_many_partitions(spark):
    """One text on most rows falls into many partitions and stays one group."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(4000).selectExpr(
            "id as doc_id", "case when id % 4 < 3 then 'same  text' else concat('t', id % 40) end as text"
        )
        rows = [(r.doc_id, r.text) for r in df.collect()]
        found = exact_dedup.groups(df).collect()
        assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in found], key=repr) == brute(rows)
        assert sum(r.kept for r in found) == 11
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty(nothing):
    assert exact_dedup.groups(nothing).count() == 0
    assert exact_dedup.deduplicated(nothing).count() == 0


def test_inner_rows_stay_where_they_lie(spark):
    """Without broadcasts, no task gets the rows whose text is of one partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(8000).selectExpr("id as doc_id", "concat('text ', id % 7000) as text")
        for made in (exact_dedup.groups(df), exact_dedup.deduplicated(df)):
            sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
            assert max(sizes) <= 3 * 8000 / 16, sorted(sizes)[-3:]
            plan = made._jdf.queryExecution().executedPlan().toString()
            scans = [line for line in plan.splitlines() if "PushedFilters" in line]
            assert any("IsNull(run)" in line for line in scans)
            assert all("IsNull(run)" in line or "IsNotNull(run)" in line for line in scans)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
