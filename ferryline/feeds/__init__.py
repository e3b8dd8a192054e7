"""Feed declarations."""

from ferryline.feeds.catalog import FEEDS, feed
from ferryline.feeds.spec import FeedSpec

__all__ = ["FEEDS", "FeedSpec", "feed"]
