"""Structured Streaming: triggers, landing with the batch writers, end-of-feed stop."""

from ferryline.streaming.keyed import close_after_end, keep_state_on_disk
from ferryline.streaming.land import BatchWriter, file_stream, land, load_name
from ferryline.streaming.run_mode import run_trigger
from ferryline.streaming.stop import EndSignal, run_until_end
from ferryline.streaming.watermark import once, with_event_time

__all__ = [
    "BatchWriter",
    "EndSignal",
    "close_after_end",
    "file_stream",
    "keep_state_on_disk",
    "land",
    "load_name",
    "once",
    "run_trigger",
    "run_until_end",
    "with_event_time",
]
