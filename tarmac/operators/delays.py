"""Mean delays per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tarmac.functions.predicates import is_arrived
from tarmac.functions.text import csv_line
from tarmac.functions.times import departure_hour


def mean_by(rows: DataFrame, keys: list, value: Column, name: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.avg(value).alias(name))


def origin_hour_delay(events: DataFrame) -> DataFrame:
    """Mean of departure delay plus taxi-out per origin and local hour, over arrivals."""
    return mean_by(
        events.where(is_arrived()),
        ["origin", departure_hour().alias("dep_hour")],
        F.col("dep_delay") + F.col("taxi_out"),
        "avg_dep_delay",
    )


def dest_arrival_delay(events: DataFrame) -> DataFrame:
    return mean_by(events.where(is_arrived()), ["dest"], F.col("arr_delay"), "avg_arr_delay")


def origin_average_delay(flights: DataFrame) -> DataFrame:
    return flights.groupBy("origin").agg(
        F.avg("dep_delay").alias("dep_delay"), F.avg("arr_delay").alias("arr_delay")
    )


def delay_lines(averages: DataFrame) -> DataFrame:
    """`ORIGIN:HH,mean` lines, the form the lookup file has."""
    key = F.concat_ws(":", "origin", "dep_hour")
    return averages.select(csv_line(key, "avg_dep_delay").alias("value"))
