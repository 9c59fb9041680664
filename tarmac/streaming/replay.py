"""Replay of the event log: which event is due when, and output by event type."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac.functions.predicates import in_half_open
from tarmac.functions.times import epoch, rfc3339


def schedule(events: DataFrame, start: str, end: str, speed: float = 1.0) -> DataFrame:
    """Events of [start, end) in time order, with the seconds after the start at which
    each is due when time runs `speed` times faster."""
    low, high = (F.to_timestamp(F.lit(t)) for t in (start, end))
    due = (epoch("notify_time") - epoch(low)) / F.lit(float(speed))
    return (
        events.where(in_half_open("notify_time", low, high))
        .withColumns({"release_sec": due, "stamp": rfc3339("notify_time")})
        .orderBy("notify_time")
    )
