"""Event-time windows over the event log.

An hour-long window that moves every five minutes holds each event twelve times.
Here the events are first summed per key and five-minute slot; every window is a
run of such slots, so only the sums are repeated or framed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarmac.functions.predicates import is_arrived
from tarmac.functions.times import DAY, epoch, slot
from tarmac.operators.lookups import with_group_average
from tarmac.session import measured

HOUR = 3600
FIVE_MINUTES = 300


def with_slot(events: DataFrame, step: int = FIVE_MINUTES, time: str = "notify_time") -> DataFrame:
    return events.withColumn("slot", slot(epoch(time), step))


def slot_totals(
    events: DataFrame, key: str, value: Column, step: int = FIVE_MINUTES, time: str = "notify_time",
) -> DataFrame:
    """Sum and count of a value per key and slot.

    Slots in which the value is never known stay, with count 0: an event there
    may still need the mean of the slots before it.
    """
    return (
        with_slot(events, step, time)
        .groupBy(key, "slot")
        .agg(F.sum(value).alias("total"), F.count(value).alias("n"))
    )


def sliding_means(
    totals: DataFrame, key: str, span: int = HOUR, step: int = FIVE_MINUTES,
) -> DataFrame:
    """Mean per key and sliding window, for every window with a known value."""
    starts = F.sequence(F.col("slot") - (span - step), F.col("slot"), F.lit(step))
    return (
        totals.where("n > 0")
        .withColumn("window_start", F.explode(starts))
        .groupBy(key, "window_start")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .select(
            key, "window_start", (F.col("window_start") + span).alias("window_end"),
            (F.col("total") / F.col("n")).alias("mean"), "n",
        )
    )


def trailing_means(
    totals: DataFrame, key: str, name: str, span: int = HOUR, step: int = FIVE_MINUTES,
) -> DataFrame:
    """Per key and slot: the mean over the slots of the past `span` seconds.

    A range frame partitioned by the key alone would put the whole history of a
    busy key into one task.  The frames are cut by day instead: the last slots of
    a day also go to the next day as lead-in, and are dropped once the frame is
    computed.  A frame partition then has at most a day and an hour of slots.
    """
    day = F.floor(F.col("slot") / DAY)
    reach = F.floor((F.col("slot") + (span - step)) / DAY)
    frame = Window.partitionBy(key, "part").orderBy("slot").rangeBetween(-(span - step), 0)
    return (
        totals.withColumn("part", F.explode(F.sequence(day, reach)))
        .withColumn("sum_total", F.sum("total").over(frame))
        .withColumn("sum_n", F.sum("n").over(frame))
        .where((F.col("part") == day) & (F.col("sum_n") > 0))
        .select(key, "slot", (F.col("sum_total") / F.col("sum_n")).alias(name))
    )


def in_last(minutes_of_slot: int, step: int = FIVE_MINUTES, time: str = "notify_time") -> Column:
    """True in the last minutes of a slot: the copy of an event that its newest
    window keeps when the slice is shorter than the step."""
    end = slot(epoch(time), step) + step
    return end - epoch(time) <= minutes_of_slot * 60


def with_arrival_average(
    events: DataFrame, mean_over: str = "hour", slice_minutes: int = 5,
) -> DataFrame:
    """Attach the recent mean arrival delay at the destination to every event.

    `mean_over="hour"` takes the past hour up to the end of the event's slot;
    `"slice"` takes the events of that slot alone.  A slice below five minutes
    keeps only the events in the last minutes of a slot.

    The means, one row per destination and slot, are stored, so that they are
    broadcast where they are small: the events themselves are then not shuffled.
    """
    kept = events if slice_minutes >= 5 else events.where(in_last(slice_minutes))
    known = F.when(is_arrived(), F.col("arr_delay"))
    totals = slot_totals(kept, "dest", known)
    if mean_over == "hour":
        means = trailing_means(totals, "dest", "avg_arr_delay")
    elif mean_over == "slice":
        means = totals.where("n > 0").select(
            "dest", "slot", (F.col("total") / F.col("n")).alias("avg_arr_delay")
        )
    else:
        raise ValueError(f"mean_over must be 'hour' or 'slice', not {mean_over!r}")
    means = measured(means, "arrival-averages")
    joined = with_group_average(with_slot(kept), means, ["dest", "slot"], "avg_arr_delay")
    return joined.drop("slot")


def per_window(events: DataFrame) -> DataFrame:
    """Every event once per window that holds it, with that window's mean.

    The twelve-fold output is what is asked for here; the means are still computed
    from slot sums.  Each slot gets a map of the means of its windows, at most
    twelve, and the events are joined with it as they are: they are copied after
    the shuffle, not before.  A window without a mean gives 0.
    """
    known = F.when(is_arrived(), F.col("arr_delay"))
    totals = slot_totals(events, "dest", known)
    windows = F.sequence(F.col("slot") - (HOUR - FIVE_MINUTES), F.col("slot"), F.lit(FIVE_MINUTES))
    means = sliding_means(totals, "dest").select("dest", "window_start", F.col("mean").alias("window_mean"))
    per_slot = (
        totals.select("dest", "slot", F.explode(windows).alias("window_start"))
        .join(means, ["dest", "window_start"])
        .groupBy("dest", "slot")
        .agg(F.map_from_entries(F.collect_list(F.struct("window_start", "window_mean"))).alias("window_means"))
    )
    joined = with_slot(events).join(per_slot, ["dest", "slot"], "left")
    copies = joined.withColumn("window_start", F.explode(windows))
    mean = F.coalesce(F.col("window_means")[F.col("window_start")], F.lit(0.0))
    return copies.withColumn("avg_arr_delay", mean).drop("slot", "window_means")
