"""Run modes of a feed as triggers."""

from __future__ import annotations

# The two run modes a feed can be started in.
AT_ONCE = "AT_ONCE"
SCHEDULED = "SCHEDULED"


def run_trigger(mode: str, interval: str = "60 seconds") -> dict[str, object]:
    """``AT_ONCE`` takes all there is in bounded batches and stops; ``SCHEDULED`` polls.

    The interval carries its unit, as in ``"60 minutes"``.
    """
    if mode == AT_ONCE:
        return {"availableNow": True}
    if mode == SCHEDULED:
        return {"processingTime": interval}
    raise ValueError(f"unknown run mode: {mode}")
