import base64
import random
import re

import corpus_pipeline
from ferryline.llm import suite


def staged(spark, tmp_path, docs, sf_dir="/root/testdata/sf0.001"):
    """The result of each stage, as the driver runs them."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_take_effect(spark, tmp_path, documents):
    language, exact, near, secrets, packed = staged(spark, tmp_path, documents)
    for stage in (language, exact, near, secrets):
        assert stage.columns == documents.columns
    kept = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert kept(language) == kept(documents)  # all are in a known language
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text) for r in language.collect()]
    assert exact.count() == len(set(normal))
    assert kept(exact) <= kept(language) and kept(near) <= kept(exact)
    assert kept(secrets) == kept(near) == kept(packed)
    leaks = r"AKIA[0-9A-Z]{16}|password=[0-9a-f]{18}|token = .[0-9a-f]{40}"
    assert secrets.where(f"text rlike '{leaks}'").count() == 0


def test_texts_in_no_known_language_go(spark, documents):
    rng = random.Random(3)
    polish = (
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni "
        "obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. "
    )
    lower = "abcdefghijklmnopqrstuvwxyz"
    junk = [
        "".join(rng.choice(lower + "  ") for _ in range(300)),
        base64.b64encode(rng.randbytes(200)).decode(),
        rng.randbytes(200).hex(),
        polish,
        polish * 4,
        "".join(rng.choice(lower + lower.upper()) for _ in range(60)),
    ]
    clean = [r.text[:n] for r in documents.limit(5).collect() for n in (30, 60, 200)] + ["so", "x"]
    texts = [(-1 - i, t, None) for i, t in enumerate(junk)] + [(10**6 + i, t, None) for i, t in enumerate(clean)]
    extra = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    both = documents.unionByName(extra, allowMissingColumns=True)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, both, "").select("doc_id").collect()}
    assert kept == {r.doc_id for r in documents.collect()} | {10**6 + i for i in range(len(clean))}


def test_run_equals_the_stages(spark, tmp_path, documents):
    last = staged(spark, tmp_path, documents)[-1]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    run = corpus_pipeline.run(spark, "/root/testdata/sf0.001").select(columns)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, last.select(columns).collect()))


def test_odd_and_empty_documents(spark, tmp_path, documents, odd):
    columns = documents.columns
    extra = odd.selectExpr("doc_id", "text", "lang", "source", "cast(run as long) as n_chars")
    both = documents.select(columns).unionByName(extra)
    stages = staged(spark, tmp_path / "odd", both)
    assert stages[0].where("text is null or text = ''").count() == 0
    assert stages[-1].count() > 0
    empty = staged(spark, tmp_path / "empty", documents.where("false"))
    assert [s.count() for s in empty] == [0] * 5


def test_queries_are_registered():
    names = set(suite.queries())
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14))
