"""Writers: append, replace a batch, keyed tables, fan-out, copy and publish."""

from ferryline.sinks.apart import Counts, land_apart
from ferryline.sinks.append import (
    append,
    append_once,
    create_if_absent,
    read_table,
    replace_batch,
    replace_batches,
)
from ferryline.sinks.compact import compact_loads, read_landed
from ferryline.sinks.copy import copy_table, copy_tables
from ferryline.sinks.evolve import SchemaChanged, aligned, evolved, follow
from ferryline.sinks.fanout import Child, fan_out, route
from ferryline.sinks.jdbc import Database, DatabaseTable, jdbc_append, jdbc_types, jdbc_upsert_statement
from ferryline.sinks.keyed import KeyedTable
from ferryline.sinks.layout import ordered_by
from ferryline.sinks.merge import MergeTable
from ferryline.sinks.publish import encode_messages, end_message, export_json, publish

__all__ = [
    "Child",
    "Counts",
    "Database",
    "DatabaseTable",
    "KeyedTable",
    "MergeTable",
    "SchemaChanged",
    "aligned",
    "append",
    "append_once",
    "compact_loads",
    "copy_table",
    "copy_tables",
    "create_if_absent",
    "encode_messages",
    "end_message",
    "evolved",
    "export_json",
    "fan_out",
    "follow",
    "jdbc_append",
    "jdbc_types",
    "jdbc_upsert_statement",
    "land_apart",
    "ordered_by",
    "publish",
    "read_landed",
    "read_table",
    "replace_batch",
    "replace_batches",
    "route",
]
