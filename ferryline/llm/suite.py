"""The operators as queries over the test tables, and the SQL that they must equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.llm import (
    chat,
    exact_dedup,
    jaccard,
    language,
    neighbours,
    packing,
    pieces,
    pii,
    secrets,
    structure_queries,
    token_counts,
)
from ferryline.llm.common import table
from ferryline.session import configure

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = "byte_bpe_50k.json"


# Besides the table: a conversation that says the template's own marks.
PLANTED = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, rows.schema)
    return chat.digests(chat.formatted(rows.unionByName(planted)))


OP1_SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
escaped AS (
    SELECT *, length(role) + length(text)
        + length(role || '~' || text) - length(replace(role || '~' || text, '\', ''))
        + (length(role || '~' || text) - length(replace(role || '~' || text, '<turn ', ''))) // 6
        + (length(role || '~' || text) - length(replace(role || '~' || text, '</turn>', ''))) // 7
        + (length(role || '~' || text) - length(replace(role || '~' || text, '>' || chr(10), ''))) // 2
        + (length(role || '~' || text) - length(replace(role || '~' || text, '### Assistant:', ''))) // 14
        AS chars
    FROM rows
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(chars + 6 + 2 + 8)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH normal AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM normal
"""


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "links", "kept")


OP3_SQL = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, string_split_regex(
        regexp_replace(lower(coalesce(text, '')), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        '[\x20\x09-\x0D]+') AS w
    FROM documents
),
shingled AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM worded, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i)
    WHERE w[1] <> ''
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
meeting AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
    FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY ALL
),
link AS (
    SELECT a, b FROM meeting JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 5 * n_both >= 4 * (x.n + y.n - n_both)
),
reach AS (
    SELECT a, b FROM link
    UNION
    SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
),
class AS (SELECT a, least(a, min(b)) AS class_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS links FROM link GROUP BY a)
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(links, 0) AS links,
       coalesce(class_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN class ON class.a = d.doc_id LEFT JOIN degree ON degree.a = d.doc_id
"""


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate with its score; the secret itself only as a digest."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    digest = F.sha2("candidate", 256).alias("candidate_sha256")
    return found.select("doc_id", "place", "start", "stop", "kind", "score", "is_secret", digest)


def held_out() -> Column:
    """A fifth of the documents, by id, from which nothing is learned."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    profiles = language.learn(documents.where(~held_out()))
    rows = documents.select("doc_id", held_out().alias("held_out"), "text")
    return language.identify(rows, profiles).drop("text")


# A sample key, so that results can be repeated. Set the option for real data.
PII_KEY_OPTION, PII_SAMPLE_KEY = "spark.ferryline.pii.key", "sample key, not secret"


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(PII_KEY_OPTION, PII_SAMPLE_KEY)
    return pii.pseudonymise(table(spark, sf_dir, "documents"), key.encode())


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    return packing.packed(table(spark, sf_dir, "documents"), path)


PIECES = "piece_bpe_32k.model"


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text again."""
    path = public_tokenizers.path(PIECES)
    documents = table(spark, sf_dir, "documents")
    coded = pieces.encode(documents, path)
    back = pieces.decode(coded, path)
    return back.select("doc_id", "ids", "n_tokens", F.sha2("text", 256).alias("decoded_sha256"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.where(F.col("vec_id") % 20 == 0)
    return neighbours.search(neighbours.build(vectors), queries)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    return token_counts.count(table(spark, sf_dir, "documents"), path)


_QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_chat_formatting": (op1_chat_formatting, OP1_SQL),
    "op2_exact_dedup": (op2_exact_dedup, OP2_SQL),
    "op3_jaccard_join": (op3_jaccard_join, OP3_SQL),
    "op4_secret_scans": (op4_secret_scans, None),
    "op5_language_id": (op5_language_id, None),
    "op6_pii_pseudonyms": (op6_pii_pseudonyms, None),
    "op7_best_fit_packing": (op7_best_fit_packing, None),
    "op8_sentencepiece": (op8_sentencepiece, None),
    "op9_neighbours": (op9_neighbours, None),
    "op10_token_counts": (op10_token_counts, None),
    **structure_queries.QUERIES,
}


def _configured(query: Query) -> Query:
    return lambda spark, sf_dir: query(configure(spark), sf_dir)


def queries() -> dict[str, Query]:
    return {name: _configured(query) for name, (query, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
