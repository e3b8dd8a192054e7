"""Scans: files, messages, change logs and tables."""

from ferryline.sources.changelog import decode_changes, snapshot_changes
from ferryline.sources.files import csv_feed, json_array_files, json_document_files
from ferryline.sources.json_arrays import json_array_splits
from ferryline.sources.messages import (
    bad_messages,
    decode_arrays,
    decode_envelopes,
    decode_objects,
    decode_xml,
    kafka_options,
    read_messages,
    records_of,
    rejected,
    with_reasons,
)
from ferryline.sources.tables import (
    TableRef,
    jdbc_options,
    loaded_keys,
    normalize_types,
    point_lookup,
)

__all__ = [
    "TableRef",
    "bad_messages",
    "csv_feed",
    "decode_arrays",
    "decode_changes",
    "decode_envelopes",
    "decode_objects",
    "decode_xml",
    "jdbc_options",
    "json_array_files",
    "json_array_splits",
    "json_document_files",
    "kafka_options",
    "loaded_keys",
    "normalize_types",
    "point_lookup",
    "read_messages",
    "records_of",
    "rejected",
    "snapshot_changes",
    "with_reasons",
]
