"""Recorded assets of one sortie: metadata tables, then the part of each data table that
falls into the sortie's time."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ferryline.feeds.record_feeds import ASSET_TABLES
from ferryline.feeds.spec import LINEAGE, FeedSpec
from ferryline.functions.times import local_to_epoch_ms
from ferryline.operators.filters import optional_time_range
from ferryline.operators.lookups import first_child
from ferryline.operators.project import stamp
from ferryline.sinks.copy import copy_tables
from ferryline.sinks.keyed import KeyedTable
from ferryline.sources.messages import decode_envelopes
from ferryline.sources.tables import TableRef, point_lookup

# The label of the property that names a table's time column, and the zone
# sortie times are written in.
TIME_LABEL = "消息发生时间"
ZONE = "Asia/Shanghai"

SUMMARY, MODEL, PROPERTY = ASSET_TABLES

CONFIG = StructType(
    [
        StructField("assetModel", MODEL.source_schema),
        StructField("propertyList", ArrayType(PROPERTY.source_schema)),
    ]
)


@dataclass(frozen=True)
class AssetFrames:
    summaries: DataFrame
    models: DataFrame
    properties: DataFrame


def find_sortie(sorties: DataFrame, sortie_number: str) -> Row:
    """The sortie of a number, with its time range in epoch milliseconds."""
    timed = sorties.withColumns(
        {
            "start_ms": local_to_epoch_ms(F.col("car_start_time"), ZONE),
            "end_ms": local_to_epoch_ms(F.col("car_end_time"), ZONE),
        }
    )
    return point_lookup(timed, "sortie_number", sortie_number)


def asset_frames(
    sortie: Row, list_bodies: DataFrame, config_bodies: DataFrame, import_id: int
) -> AssetFrames:
    """Metadata of the sortie's assets.

    ``list_bodies`` has ``weapon_model``, ``icd_version`` and a response ``value`` with
    assets under ``result``; the sortie's airplane number is the weapon model.
    ``config_bodies`` has ``id`` and a response with configurations under ``result``, of
    which the first counts.
    """
    bodies = list_bodies.where(
        (F.col("weapon_model") == sortie["airplane_number"])
        & (F.col("icd_version") == sortie["icd_version"])
    )
    number = sortie["sortie_number"]
    summaries = stamp(
        decode_envelopes(bodies, SUMMARY.source_schema, "result"),
        LINEAGE,
        sortie_number=number,
        import_id=import_id,
    )
    configs = config_bodies.select(
        "id",
        F.from_json(
            "value", StructType([StructField("result", ArrayType(CONFIG))]), {"mode": "FAILFAST"}
        )
        .getField("result")
        .alias("configs"),
    )
    chosen = first_child(summaries, configs, ["id"], "configs")
    models = stamp(
        chosen.select("assetModel.*"), LINEAGE, sortie_number=number, import_id=import_id
    )
    properties = chosen.select(
        F.col("full_name"),
        F.col("assetModel.id").alias("_model_id"),
        F.posexplode("propertyList").alias("position", "_p"),
    ).select(
        "full_name",
        "position",
        *[F.col("_p").getField(c).alias(c) for c in PROPERTY.source_schema.names
          if c not in ("model_id", "sortie_number")],
        F.col("_model_id").alias("model_id"),
    )
    properties = stamp(properties, LINEAGE, sortie_number=number, import_id=import_id)
    return AssetFrames(summaries, models, properties)


def save_metadata(frames: AssetFrames, base: str, buckets: int = 1) -> None:
    """Upsert assets and models by id; replace properties by model, sortie and code.

    A code listed twice for one model keeps its last entry.
    """
    for spec, rows in ((SUMMARY, frames.summaries), (MODEL, frames.models)):
        metadata_table(spec, base, buckets).upsert(rows, ["import_id"])
    metadata_table(PROPERTY, base, buckets).upsert(frames.properties, ["position"])


def time_columns(properties: DataFrame, label: str = TIME_LABEL) -> dict[str, str]:
    """For each data table, the code of its first property with the label. Metadata-sized."""
    found = (
        properties.where(F.col("name") == label)
        .groupBy("full_name")
        .agg(F.min_by("code", "position").alias("code"))
    )
    return {row["full_name"]: row["code"] for row in found.collect()}


def asset_tables(
    summaries: DataFrame, resolve: Callable[[str, str], TableRef]
) -> dict[str, TableRef]:
    """The data table of each asset, by name; ``resolve`` finds it from its database and name.

    The list of a sortie's assets is metadata-sized. A name in two databases is an error.
    """
    listed = summaries.select("db_name", "full_name").distinct().collect()
    names = [row["full_name"] for row in listed]
    if len(set(names)) < len(names):
        raise ValueError(f"a table name is listed for two databases: {sorted(names)}")
    return {row["full_name"]: resolve(row["db_name"], row["full_name"]) for row in listed}


def copy_asset_tables(
    spark: SparkSession,
    sortie: Row,
    tables: Mapping[str, TableRef],
    columns: Mapping[str, str],
    base: str,
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """Copy each asset's table, cut to the sortie's time where the table has a time column.

    Tables without a key are laid out by that column, so that later cuts read few row groups.
    """

    def cut(column: str | None) -> Callable[[DataFrame], DataFrame]:
        return lambda df: optional_time_range(
            df, column, sortie["start_ms"], sortie["end_ms"], ZONE
        )

    select = {name: cut(columns.get(name)) for name in tables}
    return copy_tables(spark, tables, f"{base}/real_world_flight", select, buckets, columns)


def metadata_table(spec: FeedSpec, base: str, buckets: int = 1) -> KeyedTable:
    return KeyedTable(spec.location(base), spec.target_schema, spec.keys, buckets)
