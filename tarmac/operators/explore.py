"""Exploratory statistics of delays.

Delays are whole minutes, so a table of counts per value is a few thousand rows
however many flights there are.  Quantiles and sweeps start from such tables.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarmac.functions.features import LATE_MINUTES, fraction, left_on_time, likely_delay
from tarmac.session import measured

MIN_FLIGHTS = 370
# Flight-count thresholds of the outlier sweep.
SWEEP = [5, 10, 22, 100, 200, 300, 370, 500, 1000]
CONDITIONAL_QUANTILE = 70 / 101


def by_departure_delay(flights: DataFrame) -> DataFrame:
    return flights.groupBy("dep_delay").agg(
        F.avg("arr_delay").alias("arrival_delay"),
        F.stddev_samp("arr_delay").alias("stddev_arrival_delay"),
        F.count("arr_delay").alias("numflights"),
    )


def frequent_delays(flights: DataFrame, min_flights: int = MIN_FLIGHTS) -> DataFrame:
    return by_departure_delay(flights).where(F.col("numflights") > min_flights)


def counts(flights: DataFrame) -> DataFrame:
    return flights.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("dep_delay").alias("n_dep_delay"),
        F.count("arr_delay").alias("n_arr_delay"),
        F.max("dep_delay").alias("max_dep_delay"),
        F.count_if(F.col("dep_delay") > 10).alias("n_dep_after_10"),
    )


def sigma_bounds(flights: DataFrame, column: str = "dep_delay", sigmas: float = 3) -> DataFrame:
    mean, dev = F.avg(column), F.stddev_samp(column)
    return flights.agg(
        (mean - sigmas * dev).alias("flights_min"), (mean + sigmas * dev).alias("flights_max")
    )


def describe(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, least and greatest value: one row per column, one pass."""
    stats = {"n": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    one = rows.agg(*[
        F.struct(*[f(c).cast("double").alias(s) for s, f in stats.items()]).alias(c) for c in columns
    ])
    long = one.unpivot([], list(columns), "metric", "s")
    return long.select("metric", F.col("s.n").cast("bigint").alias("n"), "s.mean", "s.stddev", "s.min", "s.max")


def discrete_quantiles(
    rows: DataFrame, value: str, fractions: Sequence[float], keys: Sequence[str] = (),
) -> DataFrame:
    """Exact quantiles as an array `quantiles`: the least value whose rank reaches each fraction.

    The rows are counted per value first, so the ordered pass runs over distinct
    values; use `sketch_quantiles` for a column with unboundedly many of them.
    """
    keys = list(keys)
    known = rows.where(F.col(value).isNotNull())
    tally = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*keys)
    upto = Window.partitionBy(*keys).orderBy(value)
    ranked = tally.withColumn("rank", F.sum("n").over(upto)).withColumn("size", F.sum("n").over(whole))
    picks = [
        F.min(F.when(F.col("rank") >= F.greatest(F.lit(1), F.ceil(F.col("size") * F.lit(float(q)))), F.col(value)))
        for q in fractions
    ]
    return ranked.groupBy(*keys).agg(F.array(*picks).alias("quantiles"), F.max("size").alias("n"))


def sketch_quantiles(
    rows: DataFrame, value: str, fractions: Sequence[float], keys: Sequence[str] = (), accuracy: int = 10000,
) -> DataFrame:
    """Approximate quantiles with a rank error of 1 / `accuracy`, in one aggregation."""
    return rows.groupBy(*keys).agg(
        F.percentile_approx(value, [float(q) for q in fractions], accuracy).alias("quantiles"),
        F.count(value).alias("n"),
    )


def ranged_quantiles(rows: DataFrame, value: str, fractions: Sequence[float]) -> DataFrame:
    """Exact quantiles of a column with any number of distinct values: position and value.

    Counts per value are sorted into ranges, and the total of each range says which one
    holds a rank.  Only those ranges are summed up value by value, each in its own task;
    the driver sees one total per range.
    """
    tally = rows.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    placed = measured(
        tally.repartitionByRange("value").sortWithinPartitions("value").withColumn("part", F.spark_partition_id()), "ranges")
    totals = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    size, ends, before = sum(totals.values()), {}, 0
    for part in sorted(totals):
        ends[part] = (before, before := before + totals[part])
    wanted = []
    for position, q in enumerate(fractions):
        rank = max(1, math.ceil(size * float(q)))
        wanted += [(position, part, rank - low) for part, (low, high) in ends.items() if low < rank <= high]
    upto = Window.partitionBy("part").orderBy("value")
    running = placed.where(F.col("part").isin([w[1] for w in wanted])).withColumn("rank", F.sum("n").over(upto))
    asked = rows.sparkSession.createDataFrame(wanted, "position int, part int, least bigint")
    return running.join(asked, "part").where("rank >= least").groupBy("position").agg(F.min("value").alias("value"))


def ventiles(flights: DataFrame, column: str = "dep_delay", parts: int = 20) -> DataFrame:
    """Least value, the inner cut points and the greatest value, one row each."""
    return ranged_quantiles(flights, column, [i / parts for i in range(parts + 1)])


def conditional_quantile(
    flights: DataFrame, min_flights: int = MIN_FLIGHTS, q: float = CONDITIONAL_QUANTILE, sketch: bool = False,
) -> DataFrame:
    """The arrival delay that seven in ten flights stay below, per departure delay."""
    quantiles = sketch_quantiles if sketch else discrete_quantiles
    return (
        quantiles(flights, "arr_delay", [q], ["dep_delay"])
        .where(F.col("n") > min_flights)
        .select("dep_delay", F.col("quantiles")[0].alias("arrival_delay"), F.col("n").alias("numflights"))
    )


def outlier_sweep(flights: DataFrame, thresholds: Sequence[int] = SWEEP) -> DataFrame:
    """Rows lost and slope left for each least number of flights per delay value."""
    per_delay = flights.groupBy("dep_delay").agg(
        F.avg("arr_delay").alias("arrival_delay"),
        F.count("arr_delay").alias("numflights"),
        F.count("dep_delay").alias("n_dep"),
    )
    tried = per_delay.withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in thresholds])))
    kept = F.col("numflights") > F.col("threshold")
    weighted = {c: F.when(kept, F.col(c) * F.col("numflights")) for c in ("arrival_delay", "dep_delay")}
    return tried.groupBy("threshold").agg(
        (F.sum("n_dep") - F.sum(F.when(kept, F.col("numflights")))).alias("num_removed"),
        F.try_divide(F.avg(weighted["arrival_delay"]), F.avg(weighted["dep_delay"])).alias("lm"),
    )


def likelihood_delay(flights: DataFrame, min_flights: int = MIN_FLIGHTS) -> DataFrame:
    return frequent_delays(flights, min_flights).withColumn(
        "arr_delay_30", likely_delay("arrival_delay", "stddev_arrival_delay")
    )


def crossing(table: DataFrame, column: str, limit: float = LATE_MINUTES) -> DataFrame:
    """The least departure delay at which a conditional delay reaches the limit."""
    return table.where(F.col(column) >= limit).agg(F.min("dep_delay").alias("dep_delay"))


def confusion(flights: DataFrame, dep_limit: int = 15, arr_limit: int = 15) -> DataFrame:
    """Four counts of flights by late departure and late arrival, in one pass."""
    early_dep, late_dep = F.col("dep_delay") < dep_limit, F.col("dep_delay") >= dep_limit
    early_arr, late_arr = F.col("arr_delay") < arr_limit, F.col("arr_delay") >= arr_limit
    return _tally(flights, {
        "correct_nocancel": early_dep & early_arr,
        "wrong_nocancel": early_dep & late_arr,
        "wrong_cancel": late_dep & early_arr,
        "correct_cancel": late_dep & late_arr,
    })


def confusion_by_count(flights: DataFrame, dep_limit: int = 15, arr_limit: int = 15) -> DataFrame:
    """The same four numbers as counts of `dest`, which a null destination does not enter."""
    return confusion(flights.where(F.col("dest").isNotNull()), dep_limit, arr_limit)


def decision_fractions(tally: DataFrame) -> DataFrame:
    return tally.withColumns({
        "nocancel_fraction": fraction("correct_nocancel", "wrong_nocancel"),
        "cancel_fraction": fraction("correct_cancel", "wrong_cancel"),
    })


def boundary_eval(flights: DataFrame, keep_at: int = 15, cancel_at: int = 16) -> DataFrame:
    on_time, late = F.col("arr_delay") < LATE_MINUTES, F.col("arr_delay") >= LATE_MINUTES
    kept, dropped = F.col("dep_delay") == keep_at, F.col("dep_delay") == cancel_at
    return _tally(flights, {
        "correct_nocancel": kept & on_time,
        "wrong_nocancel": kept & late,
        "wrong_cancel": dropped & on_time,
        "correct_cancel": dropped & late,
    })


def short_haul_eval(flights: DataFrame, dep_at: int = 17, arr_limit: int = 17, under: float = 316) -> DataFrame:
    at = F.col("dep_delay") == dep_at
    return _tally(flights.where(F.col("distance") < under), {
        "wrong_cancel": at & (F.col("arr_delay") < arr_limit),
        "correct_cancel": at & (F.col("arr_delay") >= arr_limit),
    })


# Least departure delay at which a flight is given up, by distance band.
BANDS = [(None, 316, 17), (316, 493, 18), (493, 731, 18), (731, 1020, 19), (1020, None, 19)]


def banded_eval(flights: DataFrame) -> DataFrame:
    """Late arrivals that the distance-banded rule would have given up."""
    distance = F.col("distance")
    given_up = F.lit(False)
    for low, high, delay in BANDS:
        band = F.col("dep_delay") >= delay
        band = band if low is None else band & (distance >= low)
        band = band if high is None else band & (distance < high)
        given_up = given_up | band
    return _tally(flights.where(F.col("arr_delay") >= LATE_MINUTES), {"correct_cancel": given_up})


def delay_histogram(flights: DataFrame) -> DataFrame:
    return (
        flights.where(F.col("dep_delay").isNotNull())
        .groupBy("dep_delay").agg(F.count("arr_delay").alias("numflights"))
    )


def arrival_spread(flights: DataFrame, minutes: int = 10) -> DataFrame:
    """Quartiles of the arrival delay for flights that left on time and those that did not."""
    flagged = flights.withColumn("ontime", left_on_time(minutes=minutes)).where(F.col("ontime").isNotNull())
    q = F.col("quantiles")
    return discrete_quantiles(flagged, "arr_delay", [0, 0.25, 0.5, 0.75, 1], ["ontime"]).select(
        "ontime", "n", *[q[i].alias(name) for i, name in enumerate(("min", "q1", "median", "q3", "max"))]
    )


def arrival_histogram(flights: DataFrame, width: int = 5, minutes: int = 10) -> DataFrame:
    """Arrival delays counted in bins of `width` minutes, by departure flag."""
    return (
        flights.where(F.col("arr_delay").isNotNull() & F.col("dep_delay").isNotNull())
        .groupBy(
            left_on_time(minutes=minutes).alias("ontime"),
            (F.floor(F.col("arr_delay") / width) * width).alias("bin"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def histogram_2d(flights: DataFrame, x: tuple, y: tuple, grid: int = 20) -> DataFrame:
    """Counts over a square grid; `x` and `y` are (column, low, high), both ends excluded."""
    cells, inside = [], F.lit(True)
    for name, low, high in (x, y):
        inside = inside & (F.col(name) > low) & (F.col(name) < high)
        cells.append(F.floor((F.col(name) - low) * grid / (high - low)).alias(f"{name}_cell"))
    return flights.where(inside).groupBy(*cells).agg(F.count(F.lit(1)).alias("n"))


def _tally(rows: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return rows.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
