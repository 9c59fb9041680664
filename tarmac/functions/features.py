"""Labels, bins, scalings and small numeric expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Decision constants and bin edges of the delay study.
LATE_MINUTES = 15
Z_30_PERCENT = 0.52
NO_PREDICTION = -5.0
DISTANCE_EDGES = [214, 316, 394, 493, 596, 731, 868, 1020, 1269]
DELAY_EDGES = [-8, -6, -4, -3, -2, 0, 2, 6, 13]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ontime_label(arr_delay="arr_delay") -> Column:
    """1.0 on time, 0.0 late, null when the arrival delay is unknown."""
    return (_col(arr_delay) < LATE_MINUTES).cast("double")


def bin_of(value, edges) -> Column:
    """Number of edges at or below `value`; null stays null."""
    value = _col(value)
    chain = reduce(
        lambda acc, e: acc.when(value < e[1], F.lit(e[0])),
        enumerate(edges),
        F.when(value.isNull(), F.lit(None).cast("int")),
    )
    return chain.otherwise(F.lit(len(edges)))


def distance_bin(distance="distance") -> Column:
    return bin_of(distance, DISTANCE_EDGES)


def delay_bin(dep_delay="dep_delay") -> Column:
    return bin_of(dep_delay, DELAY_EDGES)


def scaled() -> dict[str, Column]:
    """The three model inputs brought to similar ranges."""
    return {
        "dep_delay": F.col("dep_delay") / 30,
        "taxi_out": F.col("taxi_out") / 10 - 1,
        "distance": F.col("distance") / 1000 - 1,
    }


def left_on_time(dep_delay="dep_delay", minutes: int = 10) -> Column:
    return _col(dep_delay) < minutes


def likely_delay(mean, stddev, z: float = Z_30_PERCENT) -> Column:
    """Delay exceeded with the probability that belongs to `z`, for a normal spread."""
    return _col(stddev) * z + _col(mean)


def fraction(part, rest) -> Column:
    """`part / (part + rest)`, null where both are zero."""
    return F.try_divide(_col(part), _col(part) + _col(rest))


def input_features() -> Column:
    """The five numeric inputs as an array; a departed event has no taxi time yet."""
    return F.array(
        F.col("dep_delay"),
        F.coalesce(F.col("taxi_out"), F.lit(0.0)),
        F.col("distance"),
        F.col("avg_dep_delay"),
        F.col("avg_arr_delay"),
    )


def ontime_decision(probability="probability") -> Column:
    """What is known about being on time: the fact after landing, else the forecast.

    Without a forecast the row gets the marker value -5.
    """
    p = _col(probability)
    landed = F.coalesce(
        (F.col("cancelled") == "0.00") & (F.col("diverted") == "0.00") & (F.col("event") == "arrived"),
        F.lit(False),
    )
    return (
        F.when(p.isNull(), F.lit(NO_PREDICTION))
        .when(landed, ontime_label())
        .otherwise(p)
    )
