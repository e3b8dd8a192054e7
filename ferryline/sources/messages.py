"""Messages: JSON objects, JSON arrays, API envelopes and XML documents.

The decoders take any frame with a text column, so one decoder serves a Kafka topic,
a file stream and a table of landed bodies, in batch and in streaming.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from ferryline.sources.files import JSON_OPTIONS

_STRICT = {"mode": "FAILFAST", **JSON_OPTIONS}

# Look-back of the first start, in milliseconds.
START_LOOK_BACK_MS = 10_000


# Bound of one micro-batch, so that a first start on a deep topic is many batches.
OFFSETS_PER_BATCH = 1_000_000

# What becomes of a message that cannot be used: the read fails, or it is left out, and
# ``rejected`` gives it with the reason.
FAIL, SKIP = "fail", "skip"

# Columns of parsed messages.
RECORDS, REASON = "_records", "_reason"
_BROKEN, _LIST = "_broken", "_list"


def kafka_options(
    servers: str,
    topics: list[str],
    now_ms: int | None = None,
    look_back_ms: int = START_LOOK_BACK_MS,
    offsets_per_batch: int = OFFSETS_PER_BATCH,
    **extra: str,
) -> dict[str, str]:
    """Reader options that start at now minus a look-back.

    The bound only matters on the first start; later the checkpoint decides.
    """
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingTimestamp": str(now_ms - look_back_ms),
        "startingOffsetsByTimestampStrategy": "latest",
        "maxOffsetsPerTrigger": str(offsets_per_batch),
        **extra,
    }


def read_messages(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A Kafka stream. Needs the public spark-sql-kafka package on the cluster."""
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(
        F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp"
    )


def with_reasons(
    df: DataFrame,
    schema: StructType | ArrayType,
    value: str = "value",
    keep: list[str] | None = None,
    strict: bool = True,
    field: str | None = None,
) -> DataFrame:
    """Each message parsed once: its record or list of records, or the reason why it is bad.

    Gives ``keep``, the text, RECORDS and REASON (null for a good message), one row for each
    message, so that good and bad ones can be written from one frame (``land_apart``).
    ``schema`` is that of an object or an array. With ``field``, the records are a list
    under that field of an object; ``strict`` then does not look for other fields.
    """
    array = isinstance(schema, ArrayType)
    text = F.col(value)
    # An object marks what is wrong anywhere below it; elements of a bare list do not.
    whole, inside, shape = text, field, schema
    if array:
        whole, inside = F.concat(F.lit(f'{{"{_LIST}":'), text, F.lit("}")), _LIST
        shape = StructType([StructField(_LIST, schema)])
    elif field is not None:
        shape = StructType([StructField(field, ArrayType(schema))])
    marked = StructType([*shape, StructField(_BROKEN, StringType())])
    options = {"columnNameOfCorruptRecord": _BROKEN, **JSON_OPTIONS}
    taken = [F.from_json(whole, marked, options).alias("_parsed")]
    if array:  # a text such as [],"x":1 is a list within the object only
        taken.append(F.json_object_keys(whole).alias("_fields"))
    if field is not None or (strict and not array):
        taken.append(F.json_object_keys(text).alias("_keys"))
    elif strict:
        each = F.from_json(text, "array<map<string,string>>", JSON_OPTIONS)
        keys = F.flatten(F.transform(F.filter(each, F.isnotnull), F.map_keys))
        taken.append(keys.alias("_keys"))
    columns = list(dict.fromkeys([*(keep or []), value]))
    # A step of its own: Spark does not repeat such columns where they are used.
    df = df.select(*columns, *taken)

    trimmed = F.trim(text)
    opening = "[" if array else "{"
    reason = F.when(F.coalesce(trimmed == "", F.lit(True)), F.lit("null or blank")).when(
        ~trimmed.startswith(opening), F.lit(f"does not begin with {opening}")
    )
    if field is not None:
        reason = reason.when(~F.array_contains("_keys", field), F.lit(f"no field {field}"))
    elif strict:
        names = (schema.elementType if array else schema).names
        unknown = F.array_except("_keys", F.array(*map(F.lit, names)))
        listed = F.concat(F.lit("unknown fields: "), F.array_join(unknown, ", "))
        reason = reason.when(F.size(unknown) > 0, listed)
    # What follows a whole value is not looked at by the parser.
    ends = F.rtrim(text, F.lit(" \t\r\n")).endswith("]" if array else "}")
    broken = F.col("_parsed").getField(_BROKEN).isNotNull() | ~ends
    if array:
        broken = broken | F.coalesce(F.size("_fields") != 1, F.lit(True))
    reason = reason.when(broken, F.lit("broken"))
    records = F.col("_parsed") if inside is None else F.col("_parsed").getField(inside)
    return df.select(*columns, records.alias(RECORDS), reason.alias(REASON))


def records_of(parsed: DataFrame, schema: StructType | ArrayType, keep: list[str] | None = None) -> DataFrame:
    """The records of the good messages of ``with_reasons``."""
    names = (schema.elementType if isinstance(schema, ArrayType) else schema).names
    return _records(parsed.where(F.col(REASON).isNull()), names, keep or [])


def bad_messages(parsed: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """The bad messages of ``with_reasons``: ``keep``, the text and its ``reason``."""
    columns = [c for c in dict.fromkeys([*(keep or []), value]) if c != "reason"]
    bad = parsed.where(F.col(REASON).isNotNull())
    return bad.select(*columns, F.col(REASON).alias("reason"))


def _records(parsed: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    if isinstance(parsed.schema[RECORDS].dataType, ArrayType):
        # Not explode: for that Spark tests the list before, which parses each text again.
        parsed = parsed.select(*keep, F.explode_outer(RECORDS).alias(RECORDS))
        parsed = parsed.where(F.col(RECORDS).isNotNull())
    return parsed.select(*keep, *[F.col(RECORDS).getField(n).alias(n) for n in names])


def _decoded(
    df: DataFrame,
    schema: StructType | ArrayType,
    value: str,
    keep: list[str],
    bad: str,
    strict: bool = True,
    field: str | None = None,
) -> DataFrame:
    """The records, by policy for bad messages."""
    parsed = with_reasons(df, schema, value, keep, strict, field)
    if bad == SKIP:
        return records_of(parsed, schema, keep)
    if bad != FAIL:
        raise ValueError(f"bad must be {FAIL!r} or {SKIP!r}")
    reason = F.col(REASON)
    told = F.when(reason == "broken", F.concat(F.lit("Malformed message: "), F.left(value, F.lit(200))))
    told = told.otherwise(F.concat(F.lit("bad message: "), reason))
    checked = F.when(reason.isNotNull(), F.raise_error(told)).otherwise(F.col(RECORDS))
    names = (schema.elementType if isinstance(schema, ArrayType) else schema).names
    return _records(parsed.select(*keep, checked.alias(RECORDS)), names, keep)


def rejected(df: DataFrame, schema: DataType, value: str = "value", strict: bool = True) -> DataFrame:
    """The messages that ``bad="skip"`` leaves out of objects or arrays, with their reason."""
    return bad_messages(with_reasons(df, schema, value, df.columns, strict), value, df.columns)


def decode_objects(
    df: DataFrame,
    schema: StructType,
    value: str = "value",
    keep: list[str] | None = None,
    bad: str = FAIL,
    strict: bool = True,
) -> DataFrame:
    """One message, one record. ``keep`` carries columns such as a message offset along.

    A null or blank message, one that is no object, and, if ``strict``, one with fields
    that are not declared, is bad.
    """
    return _decoded(df, schema, value, keep or [], bad, strict)


def decode_arrays(
    df: DataFrame,
    schema: StructType,
    value: str = "value",
    keep: list[str] | None = None,
    bad: str = FAIL,
    strict: bool = True,
) -> DataFrame:
    """One message is a list of records; null elements are dropped. Bad as in objects."""
    return _decoded(df, ArrayType(schema), value, keep or [], bad, strict)


def decode_envelopes(
    df: DataFrame,
    schema: StructType,
    field: str = "data",
    value: str = "value",
    keep: list[str] | None = None,
    bad: str = FAIL,
) -> DataFrame:
    """The records sit in a list under one field (``data`` or ``result``) of a JSON object.

    A body without the field, such as an error body, is bad; a null list has no records.
    """
    return _decoded(df, schema, value, keep or [], bad, field=field)


def decode_xml(
    df: DataFrame,
    schema: StructType,
    value: str = "value",
    xml_field: str = "xml",
    keep: list[str] | None = None,
    carry: StructType | None = None,
) -> DataFrame:
    """A JSON list whose first element holds an XML document; gives the decoded root.

    ``carry`` names further fields of that element to keep next to the document.
    """
    fields = [StructField(xml_field, StringType())] + list(carry or [])
    listed = F.from_json(F.col(value), ArrayType(StructType(fields)), _STRICT)
    first = F.get(listed, F.lit(0))
    carried = [f.name for f in carry or []]
    return (
        df.select(*(keep or []), first.alias("_e"))
        .select(
            *(keep or []),
            *[F.col("_e").getField(c).alias(c) for c in carried],
            F.from_xml(F.col("_e").getField(xml_field), schema, {"mode": "FAILFAST"}).alias("_r"),
        )
        .select(*(keep or []), *carried, "_r.*")
    )

