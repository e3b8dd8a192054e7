"""Records to JSON messages and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimeType

from ferryline.feeds.spec import FeedSpec
from ferryline.functions.times import time_of_day_text

# Fields that are null are written too: a reader sees every field of the record.
_ENCODE = {"ignoreNullFields": "false"}


def encode_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON text per row in ``value``, and the text of a key column in ``key`` if named.

    Messages of one key stay in order, as they share a partition of the topic. JSON knows
    no time of day, so those become ``HH:mm:ss.SSS``.
    """
    columns = [
        time_of_day_text(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, TimeType)
        else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    value = F.to_json(F.struct(*columns), _ENCODE).alias("value")
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []), value)


def end_message(spark: SparkSession, spec: FeedSpec, number: int) -> DataFrame:
    """The row a run-once producer sends last: only the control key is set."""
    if spec.control_key is None:
        raise ValueError(f"{spec.code} has no end row")
    source = next(f.source for f in spec.fields if f.target == spec.control_key)
    text = F.to_json(F.struct(F.lit(f"{spec.end_prefix}{number}").alias(source)))
    return spark.range(1).select(text.alias("value"))


def publish(
    df: DataFrame, servers: str, topic: str, key: str | None = None, **extra: str
) -> None:
    """Send rows to a topic, those of one ``key`` in order. Needs the public spark-sql-kafka package on the cluster."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, **extra}
    encode_messages(df, key).write.format("kafka").options(**options).save()


def export_json(df: DataFrame, folder: str, name: str, now_ms: int) -> str:
    """Write rows as JSON lines below a directory named by feed and time; gives its path.

    Tasks write their own files, so nothing passes through one machine.
    """
    path = f"{folder}/{name}_{now_ms}"
    encode_messages(df).write.text(path)
    return path
