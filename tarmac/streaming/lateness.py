"""Zero lateness, row by row: a row is late when its window had closed before its batch began."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarmac.streaming.runs import each_batch


class Watermark:
    """The largest event time of all batches up to a number, one stored value per batch.

    Each batch stores its own value, taken from that of the batch before, so a repeated
    batch finds and leaves what it did the first time.
    """

    def __init__(self, spark: SparkSession, path: str, time: str) -> None:
        self.spark, self.path, self.time = spark, path, time

    def before(self, number: int):
        """The watermark that batch `number` begins with, as a timestamp; None for the first."""
        return self.spark.read.parquet(f"{self.path}/batch={number - 1}").first()["high"] if number else None

    def store(self, rows: DataFrame, number: int):
        """Take the rows of batch `number` in; the watermark it ends with."""
        high = rows.agg(F.max(self.time).alias("high")).select(F.greatest("high", F.lit(self.before(number)).cast("timestamp")).alias("high"))
        high.write.mode("overwrite").parquet(f"{self.path}/batch={number}")
        return self.before(number + 1)


def is_late(watermark, time: str, width: str) -> Column:
    """True where the window of a row had ended at `watermark`, and for rows without a time."""
    # A window over a null time would take the row away.
    end = F.window(F.coalesce(F.col(time).cast("timestamp"), F.timestamp_seconds(F.lit(0))), width)["end"]
    return F.col(time).isNull() | F.coalesce(end <= F.lit(watermark).cast("timestamp"), F.lit(False))


def split_late(stream: DataFrame, path: str, state: str, time: str = "ts", width: str = "1 minute", drain: bool = True):
    """All rows of `stream`, in `path`/rows, with `late`, by which they are kept in folders of their own.

    The engine's own filter for late rows lags a batch behind and drops them; here each
    row is held against the watermark that its batch began with, and on-time and late
    rows together are the input.
    """
    watermark = Watermark(stream.sparkSession, f"{path}/watermark", time)

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("late", is_late(watermark.before(number), time, width))
        target = f"{path}/rows/batch={number}"
        rows.write.mode("overwrite").partitionBy("late").parquet(target)
        stored = stream.sparkSession.read.schema(rows.schema).parquet(target)
        watermark.store(stored, number)

    return each_batch(stream, write, state, drain=drain)


def split_rows(spark: SparkSession, stream: DataFrame, path: str) -> DataFrame:
    """What `split_late` has stored: the columns of `stream`, late and batch."""
    schema = stream.schema.add("late", "boolean").add("batch", "integer")
    return spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(f"{path}/rows/batch=*")
