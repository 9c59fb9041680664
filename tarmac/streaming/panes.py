"""Windows that fire early: keyed state with timers, discarding panes, late rows told apart."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "kind string, n bigint, first_at bigint, fired_at bigint, watermark bigint"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class PaneCounter(StatefulProcessor):
    """Counts of one window and key since the last firing.

    A pane opens with its first row and fires `delay` later by the processing clock, or
    before that as soon as the watermark has passed the window; what was fired is
    forgotten.  Rows of a window that the watermark has passed are late.  Timers go by
    the processing clock, so while a pane is open the watermark is looked at every `poll`.
    """

    def __init__(self, fields: list[str], delay: int, poll: int) -> None:
        self.fields, self.delay, self.poll = fields, delay, poll

    def _row(self, *values) -> Row:
        return Row(**dict(zip(self.fields, values)))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pane = handle.getValueState("pane", "n bigint, first_at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = sum(r.n for r in rows)
        now, watermark = timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs()
        if key[0] <= watermark:
            yield self._row(*key, "late", n, now, now, watermark)
        elif self.pane.exists():
            before, first_at = self.pane.get()
            self.pane.update((before + n, first_at))
        else:
            self.pane.update((n, now))
            self.handle.registerTimer(now + min(self.poll, self.delay))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.pane.exists():
            return
        n, first_at = self.pane.get()
        now, watermark = timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs()
        closed = key[0] <= watermark
        if closed or now >= first_at + self.delay:
            self.pane.clear()
            yield self._row(*key, "final" if closed else "early", n, first_at, now, watermark)
        else:
            self.handle.registerTimer(min(now + self.poll, first_at + self.delay))

    def close(self) -> None:
        pass


def fired(
    messages: DataFrame, keys: list[str], time: str = "ts", width: str = "1 minute", lateness: str = "0 seconds",
    delay: float = 60, poll: float = 1, salts: int = 1,
) -> DataFrame:
    """One row per firing: window_start, the keys, kind (early, final, late), n, and when.

    Firings of a window add up to its rows; late ones come apart, in the batch they
    arrive in.  `delay` and `poll` are seconds.  With `salts` a busy key is counted in
    several parts, each with panes of its own.  Start it inside `timers`.
    """
    window = F.window(time, width)
    part = F.pmod(F.xxhash64(*messages.columns), F.lit(salts)) if salts > 1 else F.lit(0)
    rows = messages.withWatermark(time, lateness).where(F.col(time).isNotNull()).select(
        F.unix_millis(window["end"]).alias("window_end"), F.unix_millis(window["start"]).alias("start"), *keys,
        part.cast("int").alias("part"), F.lit(1).cast("bigint").alias("n"), time)
    by = rows.select("window_end", "start", *keys, "part")
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in by.schema)
    fields = [*by.columns, *(f.split()[0] for f in OUTPUT.split(", "))]
    out = rows.groupBy(*by.columns).transformWithState(
        PaneCounter(fields, int(1000 * delay), int(1000 * poll)), f"{shape}, {OUTPUT}", "Append", "ProcessingTime")
    return out.select(F.timestamp_millis("start").alias("window_start"), *keys, "kind", "n", "first_at", "fired_at", "watermark")


@contextmanager
def timers(spark: SparkSession):
    """Keyed state with timers needs the RocksDB store; a query keeps the store it was started with."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STORE, before)
