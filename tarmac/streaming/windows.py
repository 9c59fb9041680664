"""Event-time averages on streams, and events enriched with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SLOT = "5 minutes"


def window_means(
    events: DataFrame, key: str, value: Column, time: str = "ts", span: str = "1 hour", step: str = SLOT,
    lateness: str = "0 seconds",
) -> DataFrame:
    """Mean per key over windows `w` of `span` that move by `step`, as windows close.

    A first aggregation sums each step, a second one adds the sums of a window.
    State is one row per key and step and one per key and window, and no event is
    copied.
    """
    slots = (
        events.withWatermark(time, lateness)
        .groupBy(F.window(time, step).alias("w"), key)
        .agg(F.sum(value).alias("total"), F.count(value).alias("n"))
    )
    return (
        slots.withColumn("slot_time", F.window_time("w"))
        .groupBy(F.window("slot_time", span, step).alias("w"), key)
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .select("w", key, F.try_divide("total", "n").alias("mean"), "n")
    )


def sliding_averages(
    events: DataFrame, key: str, value: Column, time: str = "ts", span: str = "1 hour", step: str = SLOT,
    lateness: str = "0 seconds",
) -> DataFrame:
    """Mean per key over windows of `span` that move by `step`: window_start, window_end, key, mean, n."""
    means = window_means(events, key, value, time, span, step, lateness)
    return means.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "mean", "n")


def enriched(
    events: DataFrame, key: str, value: Column, time: str = "ts", span: str = "1 hour", step: str = SLOT,
    lateness: str = "0 seconds", name: str = "mean", salts: int = 8,
) -> DataFrame:
    """Events with the trailing mean of their key, as a stream of its own: no stored copy is read.

    The stream is joined with its own sliding averages on the key and the time of the
    last step both belong to.  That time carries the watermark on both sides, so an
    event stays in state until the window that ends with its step has closed, comes
    out once, and is forgotten.  A key's events of one step are dealt over `salts`
    parts, so a busy key does not lie in one task; its means, one row per step, are
    repeated for them.  Events that come after their window has closed are dropped.
    """
    means = window_means(events, key, value, time, span, step, lateness).select(
        F.struct(key).alias("mean_key"), F.window_time("w").alias("mean_step"), F.coalesce("mean", F.lit(0.0)).alias(name),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("mean_salt"),
    )
    # Packed, so that the step is the only time column of this side too.
    held = events.withWatermark(time, lateness).withColumn("event_window", F.window(time, step)).select(
        F.struct(*events.columns).alias("event"), F.window_time("event_window").alias("event_step"), F.struct(key).alias("event_key"),
        F.pmod(F.xxhash64(*events.columns), F.lit(salts)).cast("int").alias("event_salt"),
    )
    same = (
        (F.col("event_key") == F.col("mean_key")) & (F.col("event_step") == F.col("mean_step"))
        & (F.col("event_salt") == F.col("mean_salt"))
    )
    return held.join(means, same).select("event.*", name)
