"""The binned on-time table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac.functions.features import delay_bin, distance_bin, ontime_label


def with_bins(flights: DataFrame) -> DataFrame:
    return flights.withColumns({
        "distbin": distance_bin(), "depdelaybin": delay_bin(), "ontime": ontime_label(),
    })


def ontime_table(flights: DataFrame) -> DataFrame:
    """Share of on-time arrivals per distance and delay bin.

    Flights with an unknown arrival delay count neither way.
    """
    return (
        with_bins(flights).groupBy("distbin", "depdelaybin")
        .agg(F.avg("ontime").alias("ontime"))
        .withColumnsRenamed({"distbin": "dist", "depdelaybin": "delay"})
    )
