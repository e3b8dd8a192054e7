"""Every operator and feed as a query over the test tables, with the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ferryline.session import configure
from ferryline.suite import feeds, keyed, rows, scans, streams, writes

Query = Callable[[SparkSession, str], DataFrame]


def _configured(query: Query) -> Query:
    return lambda spark, sf_dir: query(configure(spark), sf_dir)


def _all() -> dict[str, tuple[Query, str]]:
    found: dict[str, tuple[Query, str]] = {}
    for module in (scans, rows, keyed, writes, streams, feeds):
        found |= module.QUERIES
    return dict(sorted(found.items()))


def queries() -> dict[str, Query]:
    return {name: _configured(query) for name, (query, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items()}
