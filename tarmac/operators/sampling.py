"""Samples, splits, order and slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarmac.functions.keys import hash_fraction, keep_fraction


def bernoulli(rows: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    return rows.sample(withReplacement=False, fraction=fraction, seed=seed)


def by_key(rows: DataFrame, fraction: float, *columns: str) -> DataFrame:
    """A sample that depends on the key alone, whatever the partitioning."""
    return rows.where(keep_fraction(fraction, *columns))


def with_holdout(days: DataFrame, fraction: float = 0.2, seed: int | None = 13) -> DataFrame:
    """Mark whole days as held out: at random by seed, or by a hash of the date without one."""
    mark: Column
    if seed is None:
        mark = hash_fraction("fl_date") < fraction
    else:
        mark = F.rand(seed) > 1 - fraction
    return days.withColumn("holdout", mark)


def row_slice(rows: DataFrame, order: list, start: int, stop: int) -> DataFrame:
    """Rows [start, stop) in the given order.

    The leading `stop` rows are found by a distributed top-k first; only those are
    numbered.
    """
    top = rows.orderBy(*order).limit(stop)
    numbered = top.withColumn("row_no", F.row_number().over(Window.orderBy(*order)) - 1)
    return numbered.where(F.col("row_no") >= start)
