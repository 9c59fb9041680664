"""Table and in-memory sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tarmac.functions import predicates


def read_event_log(
    spark: SparkSession, path: str, condition: Column | None = None, columns: list[str] | None = None,
) -> DataFrame:
    """Stored event log, partitioned by `fl_date`.

    Condition and columns end up in the scan: partitions outside the wanted days
    are not opened and unread columns are not decoded.
    """
    log = spark.read.parquet(path)
    log = log.where(condition) if condition is not None else log
    return log.select(*columns) if columns else log


def expected_events(spark: SparkSession, path: str, day: str) -> DataFrame:
    """Events up to a day, of the three kinds the scoring job accepts."""
    kinds = ("wheelsoff", "departed", "arrived")
    return read_event_log(spark, path, predicates.up_to(day, kinds))


def rows(spark: SparkSession, values, schema) -> DataFrame:
    """A DataFrame from a short in-memory list."""
    return spark.createDataFrame(values, schema)


def lines(spark: SparkSession, values: list[str]) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], "value string")
