"""Queries of conversation repair, the quality classifier and periodic runs, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.llm import periodic, quality, repair
from ferryline.llm.checksums import CRC_TABLE, crc32
from ferryline.llm.common import filled, table

NOTHING_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
WORD = r"[^\x20\x09-\x0D]+"


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    made = repair.repair(repair.damaged(conversations))
    o = conversations.select("conv_id").distinct().alias("o")
    c, d = made.conversations.alias("c"), repair.digests(made.rows).alias("d")
    joined = o.join(c, F.col("o.conv_id").eqNullSafe(F.col("c.conv_id")), "left")
    joined = joined.join(d, F.col("o.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "o.conv_id",
        *[F.coalesce(f"c.{n}", F.lit(0)).cast("long").alias(n) for n in counts],
        F.coalesce("c.audit", F.lit("")).alias("audit"),
        F.coalesce("d.repaired_sha256", F.lit(NOTHING_SHA256)).alias("repaired_sha256"),
    )


def _plus(entry: str, cost: int, edits: str) -> str:
    """Cost and edits added to a text of six digits and edits."""
    return (
        f"(lpad((left({entry}, 6)::BIGINT + {cost})::VARCHAR, 6, '0') || substr({entry}, 7) || '{edits}')"
    )


def _inserted(p: str) -> list[str]:
    """The states' entries after insertions."""
    s = [f"{p}{k}" for k in range(4)]
    one = [_plus(x, 5, "I") for x in s]
    two = [_plus(x, 10, "II") for x in s]
    return [
        s[0],
        s[1],
        f"least({s[2]}, {one[0]}, {one[1]}, {one[3]})",
        f"least({s[3]}, {two[0]}, {two[1]}, {one[2]})",
    ]


def _edited(q: str) -> list[str]:
    """The states' entries after an edit of a row with symbol y and, if truncated, more."""
    s = [f"{q}{k}" for k in range(4)]
    gone = [_plus(x, 2, "D") for x in s]

    def keep(role: str, x: str) -> str:
        return f"CASE WHEN lower(y) = '{role}' THEN {_plus(x, 0, 'K').replace('+ 0', '+ more')} END"

    def change(x: str) -> str:
        return f"CASE WHEN y <> 'D' THEN {_plus(x, 1, 'R').replace('+ 1', '+ 1 + more')} END"

    to_user = ", ".join(f for x in (s[0], s[1], s[3]) for f in (keep("u", x), change(x)))
    return [
        gone[0],
        f"least({gone[1]}, {keep('s', s[0])})",
        f"least({gone[2]}, {to_user})",
        f"least({gone[3]}, {keep('a', s[2])}, {change(s[2])})",
    ]


OP11_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
plain AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
),
ways AS (SELECT *, {crc32('key')} % 20 AS way FROM plain, crc_table),
damaged AS (
    SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN way = 1 THEN '' WHEN way = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM ways, unnest(range(CASE way WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS c(copy)
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
           right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending
    FROM damaged
),
faulty AS (
    SELECT *, CASE WHEN ending = '' THEN 'b'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
        WHEN ending NOT IN ('.', '!', '?') THEN 't' ELSE 'c' END AS fault,
        CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS initial,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
    FROM numbered
),
marked AS (
    SELECT *, CASE WHEN fault IN ('b', 'd') THEN 'D' WHEN fault = 't' THEN upper(initial) ELSE initial END AS symbol
    FROM faulty
),
summary AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
           count(*) FILTER (fault = 't') AS truncated,
           count(*) FILTER (before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal,
           string_agg(symbol, '' ORDER BY pos) AS symbols,
           list(role ORDER BY pos) AS roles, list(text ORDER BY pos) AS texts
    FROM marked GROUP BY conv_id
),
sequences AS (SELECT DISTINCT symbols FROM summary),
path AS (
    SELECT symbols, 1 AS i, '000000' AS p0, NULL::VARCHAR AS p1, NULL::VARCHAR AS p2, NULL::VARCHAR AS p3
    FROM sequences
    UNION ALL
    SELECT symbols, i + 1, {', '.join(_edited('q'))}
    FROM (
        SELECT symbols, i, {', '.join(f'{e} AS q{k}' for k, e in enumerate(_inserted('p')))},
               substr(symbols, i, 1) AS y,
               CASE WHEN substr(symbols, i, 1) IN ('S', 'U', 'A', 'X') THEN 5 ELSE 0 END AS more
        FROM path WHERE i <= length(symbols)
    )
),
solved AS (
    SELECT symbols, least({_inserted('p')[0]}, {_inserted('p')[3]}) AS best
    FROM path WHERE i = length(symbols) + 1
),
audited AS (
    SELECT s.*, left(best, 6)::BIGINT AS cost, substr(best, 7) AS audit FROM summary s JOIN solved USING (symbols)
),
walk AS (
    SELECT conv_id, roles, texts, audit, 1 AS k, 0 AS row, 0 AS state, NULL::VARCHAR AS line FROM audited
    UNION ALL
    SELECT conv_id, roles, texts, audit, k + 1, CASE WHEN e = 'I' THEN row ELSE row + 1 END, following,
           CASE WHEN e = 'D' THEN NULL
                ELSE CASE WHEN e = 'K' THEN roles[row + 1] WHEN following = 2 THEN 'user' ELSE 'assistant' END
                     || ':' || CASE WHEN e = 'I' THEN '' ELSE texts[row + 1] END END
    FROM (
        SELECT *, CASE WHEN e = 'D' THEN state
            WHEN e = 'K' THEN CASE left(roles[row + 1], 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
            WHEN state = 2 THEN 3 ELSE 2 END AS following
        FROM (SELECT *, substr(audit, k, 1) AS e FROM walk WHERE k <= length(audit))
    )
),
made AS (
    SELECT conv_id, sha256(coalesce(string_agg(line, chr(10) ORDER BY k), '')) AS repaired_sha256
    FROM walk GROUP BY conv_id
),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM ids LEFT JOIN audited ON ids.conv_id IS NOT DISTINCT FROM audited.conv_id
LEFT JOIN made ON ids.conv_id IS NOT DISTINCT FROM made.conv_id
"""


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chances of a good text; a third of the documents by id teaches nothing."""
    documents, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    third = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = quality.learn(documents, labels.where(~third), label_col="quality")
    found = quality.score(documents, model)
    return found.select("doc_id", third.alias("held_out"), "score", "predicted")


def _planted(documents: DataFrame) -> DataFrame:
    """Documents of which one in ten, by a check sum of its id, repeats some of its words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(filled("text"), F.lit(WORD), F.lit(0))
    chosen = documents.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    chosen = chosen.withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10))
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    chosen = chosen.withColumn("p", period)
    repeated = F.transform(
        F.sequence(F.lit(0), F.col("n") - F.col("a") - 1),
        lambda i: F.get("w", (F.col("a") + i % F.col("p")).cast("int")),
    )
    made = F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), repeated)
    changed = F.when(F.col("a").isNotNull(), F.array_join(made, " ")).otherwise(F.col("text"))
    return chosen.select("doc_id", changed.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_planted(table(spark, sf_dir, "documents")))
    best = F.element_at(
        F.array_sort(
            F.transform(
                "runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))
            )
        ),
        1,
    )

    def line(r: Column) -> Column:
        return F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))

    n_runs = F.size("runs").cast("long")
    found = found.withColumn("best", F.when(n_runs > 0, best)).withColumn("length", -F.col("best.less"))
    return found.select(
        "doc_id",
        n_runs.alias("n_runs"),
        F.col("best.start").alias("start"),
        "length",
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP13_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
hashed AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
           CASE WHEN doc_id IS NOT NULL THEN {crc32('doc_id::VARCHAR')} END AS h
    FROM documents, crc_table
),
sized AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g FROM hashed),
placed AS (SELECT *, CASE WHEN n > 0 AND h % 10 = 0 THEN g % n END AS a FROM sized),
cut AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
planted AS (
    SELECT doc_id, n, CASE WHEN a IS NOT NULL
        THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END)
        ELSE w END AS w
    FROM cut
),
word AS (
    SELECT doc_id, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM planted
),
meet AS (
    SELECT x.doc_id, y.i - x.i AS p, x.i AS i
    FROM word x JOIN word y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
stretch AS (
    SELECT doc_id, p, min(i) AS start, count(*) + p AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM meet)
    GROUP BY doc_id, p, island HAVING count(*) + p >= greatest(6, 4 * p)
),
run AS (SELECT doc_id, start, length, min(p) AS period FROM stretch GROUP BY ALL),
most AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS k FROM run
),
lines AS (
    SELECT doc_id, count(*) AS n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS said
    FROM run GROUP BY doc_id
),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run
),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS said
    FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
       (1000 * length) // period AS exponent_milli,
       sha256(coalesce(lines.said, '')) AS runs_sha256, sha256(coalesce(kept.said, '')) AS collapsed_sha256
FROM documents d LEFT JOIN lines USING (doc_id) LEFT JOIN kept USING (doc_id)
LEFT JOIN (SELECT * FROM most WHERE k = 1) m USING (doc_id)
"""


QUERIES = {
    "op11_structure_repair": (op11_structure_repair, OP11_SQL),
    "op12_quality": (op12_quality, None),
    "op13_periodic_runs": (op13_periodic_runs, OP13_SQL),
}
