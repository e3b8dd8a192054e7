"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.session import new_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Later steps then start from files, so a lost executor costs a read and not the work
    before it, and a frame used twice is computed once.
    """
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches cut into smaller ones, so that what is made of one at a time stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def filled(text: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))
