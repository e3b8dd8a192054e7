"""From documents to packed training sequences, in five stages.

Each stage gets what the one before it kept, read from Parquet, and decides on all of it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.llm import exact_dedup, jaccard, language, packing, secrets
from ferryline.llm.common import filled, staged
from ferryline.session import configure

TOKENIZER = "byte_bpe_50k.json"
# A text that scores less shares next to no n-gram with any known language.
LEAST_SCORE = 0.05
# A text must reach this share of the median score of labelled texts of its language and
# length. Clean texts vary little around it; letters at random and other languages in the
# same script reach about half.
LEAST_SHARE = 0.65
# Shorter texts (in letters) say too little to be dropped by that.
SHORT = 16
# Lengths (by powers of two) with fewer labelled texts take the language's median.
LEAST_GROUP = 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no known language; name the language where it is missing.

    Dropped are texts that are null, have no letters, score below LEAST_SCORE or, from SHORT
    letters on, below ``least_scores`` of the language they are nearest to.

    Profiles come from all documents of this stage that have a language. Without any, no
    language is known, and nothing can be rejected for it: only texts without letters go.
    """
    configure(spark)
    profiles = language.learn(docs)
    if not profiles.languages:
        return docs.where(filled("text").rlike(r"\p{L}"))
    limits = least_scores(docs, profiles)
    names = [f"c{i}" for i in range(len(docs.columns))]
    text, lang = (names[docs.columns.index(c)] for c in ("text", "lang"))
    found = language.identify(docs.toDF(*names), profiles, text)
    found = found.withColumn("_letters", _letters(text))
    # One row for each language and power of two.
    near = found.join(
        F.broadcast(limits),
        (F.col("lang_pred") == F.col("_lang")) & (_length_class("_letters") == F.col("_class")),
        "left",
    )
    least = F.when(F.col("_letters") < SHORT, LEAST_SCORE).otherwise(
        F.greatest(F.lit(LEAST_SCORE), F.coalesce("_least", F.lit(LEAST_SCORE)))
    )
    known = near.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least))
    return known.withColumn(lang, F.coalesce(lang, "lang_pred")).select(*names).toDF(*docs.columns)


def _letters(text: str) -> Column:
    return F.length(F.regexp_replace(filled(text), r"\P{L}+", ""))


def _length_class(n: str) -> Column:
    return F.floor(F.log2(F.greatest(F.col(n), F.lit(1)).cast("double"))).cast("int")


def least_scores(docs: DataFrame, profiles: language.Profiles) -> DataFrame:
    """The least score of a text by language and length: _lang, _class, _least.

    Scores are those of all documents labelled with the language, so that a few wrong labels
    move no median. They are rounded, which bounds what is held of each group.
    """
    rows = docs.where(F.col("lang").isNotNull()).select("lang", "text")
    scored = language.identify(rows, profiles).where(F.col("lang") == F.col("lang_pred"))
    scored = scored.withColumn("_letters", _letters("text")).where(F.col("_letters") >= SHORT)
    scored = scored.select("lang", _length_class("_letters").alias("class"), F.round("score", 3).alias("score"))
    groups = scored.rollup("lang", "class").agg(
        F.expr("percentile(score, 0.5)").alias("median"), F.count("*").alias("n")
    )
    groups = groups.where("lang is not null").collect()  # languages times some 30
    whole = {r["lang"]: r["median"] for r in groups if r["class"] is None}
    by_class = {(r["lang"], r["class"]): r["median"] for r in groups if r["n"] >= LEAST_GROUP}
    least = [
        (lang, c, LEAST_SHARE * by_class.get((lang, c), median))
        for lang, median in whole.items()
        for c in range(32)
    ]
    return docs.sparkSession.createDataFrame(least, "_lang string, _class int, _least double")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    configure(spark)
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    configure(spark)
    found = jaccard.join(docs).where("kept").select(F.col("doc_id").alias("_id"), "text_hash")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (
        F.xxhash64(filled("text")) == F.col("text_hash")
    )
    return docs.join(found, same, "left_semi")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in texts; every document stays."""
    configure(spark)
    return secrets.redacted(docs, secrets.scan(docs)).withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences."""
    configure(spark)
    return packing.packed(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("exact_copies", drop_copies),
    ("near_copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# Neither rank-order profiles nor a forest nor token ids can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result but the last is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
