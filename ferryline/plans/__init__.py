"""Whole feeds: read, decode, map, stamp and write."""

from ferryline.plans.run import load, load_stream, read_feed, to_target

__all__ = ["load", "load_stream", "read_feed", "to_target"]
