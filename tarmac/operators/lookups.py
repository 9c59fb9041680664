"""Joins of events with small tables and with each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac.functions.times import departure_hour


def join_days(flights: DataFrame, days: DataFrame, is_train: bool) -> DataFrame:
    """Inner join with the days that carry the wanted flag; keeps the day's columns."""
    return flights.join(days.where(F.col("is_train_day") == is_train), "fl_date")


def select_days(flights: DataFrame, days: DataFrame | None, train: bool = True) -> DataFrame:
    """Flights of training days, or those of all other days."""
    if days is None:
        raise ValueError("the training-day table is missing")
    wanted = days.where("is_train_day").select("fl_date")
    return flights.join(wanted, "fl_date", "left_semi" if train else "left_anti")


def with_departure_average(events: DataFrame, averages: DataFrame, strict: bool = False) -> DataFrame:
    """Attach the mean departure delay of the event's origin and local hour.

    `averages` has (origin, dep_hour, avg_dep_delay) and should be a stored table
    (see `tarmac.session.measured`).  A missing key counts as 0, or is an error
    under `strict`.
    """
    joined = events.withColumn("dep_hour", departure_hour()).join(
        averages, ["origin", "dep_hour"], "left"
    )
    found = F.col("avg_dep_delay")
    missing = (
        F.raise_error(F.concat(F.lit("no departure average for "), "origin", F.lit(":"), "dep_hour"))
        .cast("double") if strict else F.lit(0.0)
    )
    value = F.when(found.isNotNull(), found).otherwise(missing)
    return joined.select(*events.columns, value.alias("avg_dep_delay"))


def with_group_average(rows: DataFrame, averages: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Left join of per-key means, 0 where a key has none.

    The means are one row per key, so only the side of the rows can be skewed;
    there adaptive execution splits a hot key over several tasks.
    """
    joined = rows.join(averages.select(*keys, column), keys, "left")
    return joined.withColumn(column, F.coalesce(column, F.lit(0.0)))
