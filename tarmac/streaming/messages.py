"""Message streams: stamping, one-minute windows, early results, output by window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac.functions.text import stamped


def stamp(messages: DataFrame) -> DataFrame:
    """(timestamp, message) rows stamped with the processing time."""
    return messages.select(F.current_timestamp().cast("timestamp_ntz").alias("timestamp"), "message")


def stamp_lines(messages: DataFrame, *more: str) -> DataFrame:
    """The same as one text line per message, with `more` columns of it."""
    return messages.select(*more, stamped("message").alias("value"))


def window_counts(
    messages: DataFrame, keys: list[str], time: str = "ts", width: str = "1 minute", lateness: str = "0 seconds",
) -> DataFrame:
    """Counts per fixed window and key.

    In append mode a window appears once, when the watermark passes its end; rows
    later than that are dropped.  In update mode it appears whenever it changed.
    """
    return (
        messages.withWatermark(time, lateness)
        .groupBy(F.window(time, width).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")
    )


def latest(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Final state of an update-mode output: the newest batch of each key."""
    newest = F.max_by(F.col("n"), F.col("batch")).alias("n")
    return updates.groupBy(*keys).agg(newest, F.max("batch").alias("batch"))
