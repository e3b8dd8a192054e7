"""All feeds by code."""

from __future__ import annotations

from ferryline.feeds.csv_feeds import CSV_FEEDS
from ferryline.feeds.record_feeds import RECORD_FEEDS
from ferryline.feeds.spec import FeedSpec

FEEDS: dict[str, FeedSpec] = {spec.code: spec for spec in CSV_FEEDS + RECORD_FEEDS}


def feed(code: str) -> FeedSpec:
    return FEEDS[code]
