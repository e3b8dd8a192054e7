"""Sorties: batches and the sorties of each batch, from landed API bodies to messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ferryline.feeds.catalog import feed
from ferryline.operators.lookups import parent_children
from ferryline.sinks.publish import encode_messages
from ferryline.sources.messages import decode_envelopes


def batch_records(bodies: DataFrame) -> DataFrame:
    """Bodies hold batches under ``data``."""
    return decode_envelopes(bodies, feed("F48").source_schema, "data")


def sortie_records(batches: DataFrame, bodies: DataFrame) -> DataFrame:
    """Sorties of all given batches. ``bodies`` has ``batch_id`` and the response ``value``."""
    wanted = parent_children(
        batches.selectExpr("id AS batch_id"), bodies.select("batch_id", "value"), ["batch_id"]
    )
    return decode_envelopes(wanted, feed("F49").source_schema, "data")


def sortie_messages(batches: DataFrame, bodies: DataFrame) -> DataFrame:
    return encode_messages(sortie_records(batches, bodies))
