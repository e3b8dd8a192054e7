"""The quality classifier: its parts by hand, and accuracy on held-out documents."""

import math

import numpy as np
from pyspark.sql import functions as F

from ferryline.llm import quality as Q
from ferryline.llm import structure_queries as S


def test_measures_by_hand():
    found = dict(zip(Q.FEATURES, Q.measures("Ab cd.\nAb cd.\n12 é!")))
    raw = "Ab cd.\nAb cd.\n12 é!".encode()
    assert found["log_chars"] == math.log1p(19) and found["log_words"] == math.log1p(6)
    assert found["letters"] == 10 / len(raw) and found["capitals"] == 2 / 8
    assert found["digits"] == 2 / len(raw) and found["marks"] == 1 / len(raw)
    assert math.isclose(found["repeated_lines"], 1 / 3) and found["lines_a_word"] == 3 / 6
    assert found["different_words"] == 4 / 6 and found["commonest_word"] == 2 / 6
    assert found["different_pairs"] == 4 / 5
    assert all(v == 0 for v in Q.measures(""))


def test_best_cut_equals_all_cuts():
    rng = np.random.default_rng(1)
    for _ in range(50):
        g, h = rng.normal(size=12), rng.uniform(0.5, 3, 12)

        def score(x, y):
            return x.sum() ** 2 / (y.sum() + Q.RIDGE) if y.sum() >= Q.LEAST_WEIGHT else -np.inf

        gains = [score(g[:k], h[:k]) + score(g[k:], h[k:]) - score(g, h) for k in range(1, 12)]
        gain, at = Q.best_cut(g, h)
        if max(gains) > 1e-9:
            assert at == 1 + int(np.argmax(gains)) and math.isclose(gain, max(gains))


def test_pairs_learn_what_single_features_cannot():
    """A label that is whether two features agree, beside fifteen features of noise."""
    rng = np.random.default_rng(2)
    values = rng.uniform(size=(4000, len(Q.FEATURES)))
    label = ((values[:, 3] > 0.5) == (values[:, 7] > 0.5)).astype(float)
    model = Q.fit(values[:3000], label[:3000])
    assert (3, 7) in [(a, b) for a, b, _ in model.pairs]
    right = (model.scores(values[3000:]) >= 0.5) == label[3000:]
    assert right.mean() > 0.95
    model.pairs = []
    assert ((model.scores(values[3000:]) >= 0.5) == label[3000:]).mean() < 0.65


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(3)
    values = rng.normal(size=(500, len(Q.FEATURES)))
    label = (values[:, 0] + values[:, 1] * values[:, 2] > 0).astype(float)
    model = Q.fit(values, label)
    bins = model.bins(values)
    for row, score in zip(bins[:20], model.scores(values)[:20]):
        total = model.intercept + sum(t[b] for t, b in zip(model.singles, row))
        total += sum(t[row[a] // 4, row[b] // 4] for a, b, t in model.pairs)
        assert math.isclose(score, 1 / (1 + math.exp(-total)), rel_tol=1e-9)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = S.op12_quality(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = found.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50 and {r["quality"] for r in rows} == {0, 1}
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found.collect())


def test_held_out_labels_teach_nothing(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    documents, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    for name, df in (("documents", documents), ("labels", turned)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    want = sorted(map(tuple, S.op12_quality(spark, sf).collect()))
    assert sorted(map(tuple, S.op12_quality(spark, str(tmp_path)).collect())) == want


def test_sample_does_not_depend_on_storage(spark, documents):
    labels = documents.select("doc_id", (F.col("doc_id") % 2).alias("label"))
    one = Q.learn(documents.repartition(7), labels.repartition(7), sample=60)
    two = Q.learn(documents.coalesce(1), labels.coalesce(1), sample=60)
    assert all((a == b).all() for a, b in zip(one.singles, two.singles))


def test_odd_rows(spark, odd, nothing):
    labelled = odd.withColumn("label", F.when(F.col("doc_id") < 5, 1).otherwise(0))
    model = Q.learn(odd, labelled)
    found = Q.score(odd, model).collect()
    assert len(found) == odd.count()
    scores = {(r["doc_id"], r["score"]) for r in found}
    assert len({s for i, s in scores if i in (3, 4)}) == 1  # null and empty
    assert all(0 <= s <= 1 for _, s in scores)
    assert Q.score(nothing, model).collect() == []
    unknown = Q.learn(nothing, nothing.withColumn("label", F.lit(1)))
    assert {r["score"] for r in Q.score(odd, unknown).collect()} == {0.5}
    one_label = Q.learn(odd, labelled.withColumn("label", F.lit(1)))
    assert all(r["score"] > 0.9 for r in Q.score(odd, one_label).collect())
