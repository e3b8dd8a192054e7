"""The test tables, and inputs of other shapes that Spark derives from them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table dealt out evenly, so that making input from one small file uses all cores."""
    return table(spark, sf_dir, name).repartition(spark.sparkContext.defaultParallelism)


def blocks(df: DataFrame, key: str, size: int, *extra: Column, name: str = "records") -> DataFrame:
    """Pack rows into lists by ranges of a unique key, so a list has at most ``size`` rows."""
    return df.groupBy(block_of(key, size).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name), *extra
    )


def long_blocks(df: DataFrame, key: str, size: int, name: str = "records") -> DataFrame:
    """``blocks`` for lists of megabytes: a task sorts its rows by list and holds one list at a time.

    Spark's aggregate for lists holds up to 128 of them in each task, beyond the memory it manages.
    """

    def packed(block: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        fields = [f.with_nullable(True) for f in rows.schema]
        structs = pa.StructArray.from_arrays([c.combine_chunks() for c in rows.columns], fields=fields)
        listed = pa.ListArray.from_arrays([0, rows.num_rows], structs)
        return pa.table([pa.array([block[0].as_py()], pa.int64()), listed], ["block", name])

    row = StructType([StructField(f.name, f.dataType) for f in df.schema])
    schema = StructType().add("block", LongType()).add(name, ArrayType(row))
    lists = df.groupBy(block_of(key, size).alias("block")).applyInArrow(packed, schema)
    return lists.withColumn(name, F.sort_array(name))


def block_of(key: str, size: int) -> Column:
    return F.expr(f"{key} DIV {size}")


def write_texts(df: DataFrame, path: str, *folders: str) -> str:
    """Write each row (``block``, ``value``) to a file of its own, below folders by columns."""
    df.select(*folders, "block", "value").write.partitionBy(*folders, "block").text(path)
    return path
