"""Secret scans with a random forest that removes false findings.

A pattern finds candidates: strings that could be keys, tokens or passwords. A forest then
decides on each by its length, its mix and transitions of characters, the share of it that
is made of words, the path of its document and the words beside it. Words and transitions
are learned from all documents; the forest from labelled findings.

Everything here is column expressions, joins and the forest of Spark ML, all on the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.common import filled, staged

# A block of a private key, what follows the name of a secret, or a long run with a digit.
_NAMES = "password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth|credential"
_RUN = "[A-Za-z0-9_+/.-]"
# Groups: the name before a value; a candidate of each kind.
CANDIDATE = (
    f"((?i:{_NAMES})[\"']?[ ]?[=:][ ]?[\"']?)([^\\s\"'=:]{{7,}}[^\\s\"'=:.,;!?)])"
    f"|(?<!{_RUN})((?:AKIA|ASIA)[0-9A-Z]{{16}}(?!{_RUN})"
    f"|(?=[A-Za-z_+/.-]*[0-9])(?!{_RUN}*?(?i:{_NAMES})[\"']?[ ]?[=:]){_RUN}{{12,}}={{0,2}})"
    "|(-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?s:.*?)-----END [A-Z ]{0,20}PRIVATE KEY-----)"
)
# A text without any of these has no candidate, and is not searched further.
_NEEDED = "[0-9=:]|A[KS]IA|-----BEGIN"
_CUT = "\u0001"

# Formats that are secrets by themselves (fixed values), and those that are none.
KNOWN = {
    "private_key": "^-----BEGIN",
    "cloud_key": "^(?:AKIA|ASIA)[0-9A-Z]{16}$",
    "code_host_token": "^gh[pousr]_[A-Za-z0-9]{36}$",
    "payment_key": "^[sr]k_(?:live|test)_[A-Za-z0-9]{16,}$",
    "chat_token": "^xox[abprs]-[A-Za-z0-9-]{10,}$",
    "web_token": r"^eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+$",
}
_HARMLESS = (
    r"^[0-9.,:/+-]+$|^(?:[A-Za-z0-9-]+\.)+[a-z]{2,}\.?$"
    r"|(?i)example|sample|dummy|placeholder|changeme|x{4,}|\*{3,}|^(.)\1+$"
)
_BESIDE_BAD = f"(?i)({_NAMES}|private|key)\\W{{0,6}}\\w{{0,12}}\\W{{0,4}}$"
_BESIDE_GOOD = r"(?i)(example|sample|checksum|sha[0-9]*|md5|commit|uuid|version|hash|digest)\W{0,4}$"

FEATURES = [
    "length", "digits", "upper", "lower", "transitions", "likelihood", "words",
    "path_test", "path_depth", "path_data", "named", "assigned", "quoted", "address",
    "harmless_beside",
]
CONTEXT = 48
MIN_COUNT = 10
TEXTS_A_COUNT = 20_000
# At most this many labelled findings of each kind are used for a fit.
MAX_LABELLED = 20_000
TREES, TREE_DEPTH, SEED = 24, 7, 7


def candidates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source"
) -> DataFrame:
    """Every candidate of every whole text, written to files.

    Returns cid, doc_id, text_hash (xxhash64 of the text), place (from 0 in its text),
    start and stop in code points, candidate, before and after (some characters beside it;
    before holds at least the word that it stands in) and path. Null texts and texts without candidates give no rows; a null path is empty;
    repeated rows give repeated candidates.
    """
    path = filled(path_col) if path_col else F.lit("")
    rows = df.where(F.col(text_col).rlike(_NEEDED)).select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(filled(text_col)).alias("text_hash"),
        path.alias("path"),
        parts(filled(text_col)).alias("parts"),
    ).where(F.size("parts") > 1)
    # Parts are, in turn, text between candidates and a candidate.
    at = F.explode(F.expr("sequence(0, size(parts) div 2 - 1)").cast("array<int>"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("place", at)
    before = F.expr("parts[2 * place]")
    # A URL that a candidate stands in may begin before the context.
    word = F.element_at(F.split(before, r"\s"), -1)
    beside = F.when(F.length(word) > CONTEXT, word).otherwise(F.substring(before, -CONTEXT, CONTEXT))
    found = rows.select(
        "row", "doc_id", "text_hash", "path", "place",
        F.length(before).alias("gap"),
        F.expr("parts[2 * place + 1]").alias("candidate"),
        beside.alias("before"),
        F.substring(F.expr("parts[2 * place + 2]"), 1, CONTEXT).alias("after"),
    )
    found = staged(found, "candidates")
    so_far = Window.partitionBy("row").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("candidate")
    stop = F.sum(F.col("gap") + size).over(so_far)
    found = found.withColumn("stop", stop).withColumn("start", F.col("stop") - size)
    return staged(
        found.select(
            F.monotonically_increasing_id().alias("cid"),
            "doc_id", "text_hash", "place", "start", "stop", "candidate", "before", "after", "path",
        ),
        "placed",
    )


def parts(text: Column) -> Column:
    """A text cut at its candidates: text, candidate, text, ..., text."""
    # The mark used for cutting must not be in the text; a space there changes no place.
    plain = F.translate(text, _CUT, " ")
    marked = F.regexp_replace(plain, CANDIDATE, f"$1{_CUT}$2$3$4{_CUT}")
    return F.split(marked, _CUT, -1)


def word_counts(df: DataFrame, text_col: str = "text", least: int = MIN_COUNT) -> DataFrame:
    """Words that enough different texts have outside candidates: word, n. Written to files.

    Words of three letters or more count, from whole texts. Copies of a text count once, and
    so does a word within a text. From TEXTS_A_COUNT * least rows on, a word must be in one
    of TEXTS_A_COUNT of them.
    """
    least = max(least, df.count() // TEXTS_A_COUNT)
    texts = df.select(F.xxhash64(filled(text_col)).alias("hash"), filled(text_col).alias("text"))
    between = F.filter(parts(F.col("text")), lambda part, i: i % 2 == 0)
    # Only words and the hash of their text are shuffled, once for each text.
    words = F.array_distinct(F.split(F.lower(F.array_join(between, " ")), r"[^\p{L}]+"))
    found = texts.select("hash", F.explode(words).alias("word")).where(F.length("word") >= 3)
    counts = found.distinct().groupBy("word").agg(F.count("*").alias("n"))
    return staged(counts.where(F.col("n") >= least), "words")


def transitions(words: DataFrame) -> dict[str, float]:
    """Log chance of a letter a-z after another in the words; at most 26 * 26 values."""
    pairs = words.where("word rlike '[a-z]{2}'").select(
        "n", F.explode(F.expr("transform(sequence(1, length(word) - 1), i -> substr(word, i, 2))")).alias("pair")
    )
    counts = pairs.where("pair rlike '^[a-z]{2}$'").groupBy("pair").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.substring("pair", 1, 1)))
    chance = F.log((F.col("n") + 1.0) / (total + 26.0))
    return {r[0]: r[1] for r in counts.select("pair", chance).collect()}


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with the columns FEATURES and their weak label, written to files.

    ``kind`` is the known format, or ``generic``. ``label`` is 1 for known formats and for
    named, assigned values, 0 for numbers, host names, addresses and placeholders, and null
    where the rules say nothing.
    """
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    size = F.length(c)
    shape = c
    for chars, mark in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0"), ("[^aA0]+", "-")):
        shape = F.regexp_replace(shape, chars, mark)

    def share(chars: str) -> Column:
        return (size - F.length(F.regexp_replace(c, chars, ""))) / size

    chances = transitions(words)
    table = F.create_map(*[F.lit(x) for pair in sorted(chances.items()) for x in pair]) if chances else None
    # Every two letters that stand beside each other, of the whole candidate.
    letters = F.regexp_extract_all(F.lower(c), F.lit("(?=([a-z]{2}))"), F.lit(1))
    unlikely = F.lit(-8.0)
    likelihood = (
        F.when(
            F.size(letters) > 0,
            F.aggregate(letters, F.lit(0.0), lambda s, p: s + F.coalesce(F.element_at(table, p), unlikely))
            / F.size(letters),
        ).otherwise(unlikely)
        if table is not None
        else unlikely
    )
    named, assigned = before.rlike(_BESIDE_BAD), before.rlike("[=:][ ]?[\"']?$")
    address = before.rlike("@$") | after.rlike("^@") | before.rlike("(?i)https?://\\S*$")
    plain = found.select(
        "*",
        F.log(size.cast("double")).alias("length"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("upper"),
        share("[a-z]").alias("lower"),
        ((F.length(shape) - 1) / size).alias("transitions"),
        likelihood.alias("likelihood"),
        F.col("path").rlike("(?i)test|example|sample|docs?/|fixture").cast("double").alias("path_test"),
        (F.size(F.split("path", "/")) - 1.0).alias("path_depth"),
        F.col("path").rlike(r"(?i)\.(csv|json|lock|sum|svg|min\.js)$").cast("double").alias("path_data"),
        named.cast("double").alias("named"),
        assigned.cast("double").alias("assigned"),
        (before.rlike("[\"']$") & after.rlike("^[\"']")).cast("double").alias("quoted"),
        address.cast("double").alias("address"),
        before.rlike(_BESIDE_GOOD).cast("double").alias("harmless_beside"),
    )
    plain = plain.join(_coverage(found, words), "cid", "left").withColumn(
        "words", F.coalesce(F.col("words") / size, F.lit(0.0))
    )
    kind = F.coalesce(*[F.when(c.rlike(p), F.lit(k)) for k, p in KNOWN.items()], F.lit("generic"))
    harmless = c.rlike(_HARMLESS) | address
    label = (
        F.when(c.rlike(_HARMLESS), 0.0)
        .when(kind != "generic", 1.0)
        .when(harmless | ((F.col("words") > 0.6) & ~named), 0.0)
        .when(named & assigned, 1.0)
    )
    return staged(plain.withColumn("kind", kind).withColumn("label", label), "features")


def _coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """Characters of each candidate that lie in known words."""
    runs = found.select(
        "cid", F.explode(F.split(F.lower("candidate"), r"[^\p{L}]+")).alias("word")
    ).where(F.length("word") >= 3)
    # Runs repeat, so they are counted before they meet the words.
    counts = runs.groupBy("cid", "word").agg(F.count("*").alias("times"))
    known = counts.join(words.select("word"), "word")
    return known.groupBy("cid").agg(F.sum(F.length("word") * F.col("times")).alias("words"))


def fit(labelled: DataFrame, most: int = MAX_LABELLED) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (FEATURES and label 0 or 1); null labels are left out.

    At most ``most`` findings of each label are used, those with the smallest hash of the
    candidate. Without findings of both labels there is no forest.
    """
    known = labelled.where("label is not null")
    chosen = None
    for label in (0.0, 1.0):
        some = known.where(F.col("label") == label).dropDuplicates(["candidate"])
        some = some.orderBy(F.xxhash64("candidate"), "candidate").limit(most)
        chosen = some if chosen is None else chosen.unionByName(some)
    chosen = staged(chosen.select("label", *FEATURES), "labelled")
    if chosen.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=TREE_DEPTH, seed=SEED
    )
    return forest.fit(_assembled(chosen))


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def scan(
    df: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = "source",
    threshold: float = 0.5,
) -> DataFrame:
    """Candidates with their kind, score (0 to 1) and whether they are secrets.

    The forest learns from ``labelled``, or else from the candidates that the rules of
    ``features`` label. Columns: those of ``candidates``, kind, score, is_secret. Without
    labelled findings of both kinds the rules alone decide. An empty table gives no rows.
    """
    found = candidates(df, id_col, text_col, path_col)
    known = features(found, word_counts(df, text_col))
    model = fit(known if labelled is None else labelled)
    if model is None:
        scored = known.withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        made = model.transform(_assembled(known))
        scored = made.withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        *found.columns, "kind", "score", (F.col("score") >= threshold).alias("is_secret")
    )


def redacted(
    df: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows of ``df`` with the secrets in their texts replaced by [SECRET:kind].

    ``found`` is what ``scan`` made of the same table. Rows without secrets stay as they
    are; other columns are kept.
    """
    one = F.struct("place", F.when(F.col("is_secret"), F.col("kind")).alias("kind"))
    decided = found.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(one)).alias("decided"), F.max("is_secret").alias("any")
    ).where("any")
    decided = decided.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "decided")
    names = [f"c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    key, text = (names[df.columns.index(c)] for c in (id_col, text_col))
    both = plain.join(
        decided, F.col(key).eqNullSafe(F.col("_id")) & (F.xxhash64(filled(text)) == F.col("_hash")), "left"
    )
    # Odd parts are candidates; the n-th decision is the n-th candidate's.
    new = F.array_join(
        F.transform(
            parts(filled(text)),
            lambda part, i: F.coalesce(
                F.when(
                    i % 2 == 1,
                    F.concat(F.lit("[SECRET:"), F.get("decided", F.floor(i / 2).cast("int"))["kind"], F.lit("]")),
                ),
                part,
            ),
        ),
        "",
    )
    changed = F.when(F.col("decided").isNotNull(), new).otherwise(F.col(text))
    return both.select(*[changed.alias(n) if n == text else n for n in names]).toDF(*df.columns)
