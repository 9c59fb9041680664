"""Starting streaming queries and draining what is available."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tarmac.session import scratch


def append_files(
    stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None, drain: bool = True,
):
    """Append finished rows to parquet files, optionally one folder per key value."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(writer, drain)


def each_batch(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    drain: bool = True, every: str | None = None,
):
    """Hand every micro-batch to `write`, which must be repeatable per batch number."""
    writer = (
        stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    )
    if every:
        writer = writer.trigger(processingTime=every)
    return _start(writer, drain)


def _start(writer, drain: bool):
    if not drain:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that owns one folder per batch number, so a retry replaces its own output."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def collected(
    spark: SparkSession, stream: DataFrame, label: str, partition_by: list[str] | None = None, arrivals: Iterable | None = None,
) -> DataFrame:
    """Drain an append-mode stream into the shared folder and read the result; with `arrivals`, once after each step."""
    path = scratch(spark, label)
    for _ in arrivals or (None,):
        append_files(stream, f"{path}/out", f"{path}/state", partition_by)
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def until_quiet(query, seconds: float = 3600) -> None:
    """Wait until a running query with timers has read what is there now and holds no state.

    Such a query runs batch after batch, and only those count that begin after this
    call: the one under way may have listed the files before the last of them came.
    """
    end, now = time.monotonic() + seconds, datetime.now(timezone.utc)
    while time.monotonic() < end:
        if query.exception():
            raise query.exception()
        last = query.lastProgress
        if last and datetime.fromisoformat(last["timestamp"]) > now and not last["numInputRows"]:
            if not any(o["numRowsTotal"] for o in last["stateOperators"]):
                return
        time.sleep(0.1)
    raise TimeoutError("the stream did not come to rest")
