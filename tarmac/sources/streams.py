"""Streaming sources and the batch/stream switch."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tarmac.functions.times import DAY, epoch
from tarmac.session import scratch


def read_files(
    spark: SparkSession, path: str, schema: StructType, streaming: bool, files_per_batch: int | None = None,
) -> DataFrame:
    """The same parquet files as a bounded table or as an unbounded stream."""
    if not streaming:
        return spark.read.schema(schema).parquet(path)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Message stream of a Kafka topic: arrival time and text.

    Needs the Kafka connector on the class path.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .load()
        .selectExpr("timestamp", "CAST(value AS STRING) AS message")
    )


class Arrivals:
    """A bounded table as a stream that grows: rows arrive in blocks of `days` of their arrival time.

    Going through it adds one block at a time to the folder that `stream` reads, so a
    drain after each step takes just that block.  With the last block comes one row
    later than all others by `after`, which must exceed the longest window: it lets all
    windows close.  Its other columns are null and its own windows stay open, so it
    never comes out of a windowed aggregation.  An empty table is one empty step.
    """

    def __init__(self, rows: DataFrame, days: int, arrival: Column | None = None, time: str = "ts", after: str = "2 hours") -> None:
        self.spark, self.rows, self.time, self.after = rows.sparkSession, rows, time, after
        at = F.col(time) if arrival is None else arrival
        self.block = F.coalesce(F.floor(epoch(at) / (days * DAY)), F.lit(0))
        self.path = scratch(self.spark, "arrivals")
        self.spark.createDataFrame([], rows.schema).write.parquet(self.path)
        self.stream = self.spark.readStream.schema(rows.schema).parquet(self.path)

    def __iter__(self) -> Iterator[int]:
        blocks = sorted(r[0] for r in self.rows.select(self.block).distinct().collect())
        for k, block in enumerate(blocks):
            part = self.rows.where(self.block == block)
            if k == len(blocks) - 1:
                part = part.unionByName(self._last())
            part.write.mode("append").parquet(self.path)
            yield k
        if not blocks:
            yield 0

    def _last(self) -> DataFrame:
        last = self.rows.agg(F.max(self.time).alias("last")).select(F.col("last") + F.expr(f"INTERVAL {self.after}"))
        return last.toDF(self.time).select(*[
            (F.col(f.name) if f.name == self.time else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.rows.schema])
