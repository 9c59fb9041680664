"""Time correction: airport lookup and conversion of local clock times to UTC."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac import schemas
from tarmac.functions.times import midnight_utc, not_before, utc_offset, utc_time

# What an airport outside the lookup is taken to be.
FALLBACK_LAT, FALLBACK_LON, FALLBACK_ZONE = 37.52, -92.17, "America/Chicago"


def with_timezone(airports: DataFrame, zones: DataFrame) -> DataFrame:
    """Add `tz` from an airport-to-zone table.

    An airport without a zone is in UTC; coordinates that are no numbers give the
    marker 'TIMEZONE'.
    """
    readable = (
        F.col("latitude").try_cast("double").isNotNull()
        & F.col("longitude").try_cast("double").isNotNull()
    )
    return (
        airports.join(zones.select("airport_seq_id", "tz"), "airport_seq_id", "left")
        .withColumn("tz", F.when(~readable, "TIMEZONE").otherwise(F.coalesce("tz", F.lit("UTC"))))
    )


def with_airports(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Coordinates and zone of both ends; unknown airports get the fallback.

    Both lookups are plain left joins: the airport table is read from storage, so
    its size decides whether it is broadcast.
    """
    for end, key in (("dep", "origin_airport_seq_id"), ("arr", "dest_airport_seq_id")):
        side = airports.select(
            F.col("airport_seq_id").alias(key),
            F.col("latitude").cast("double").alias(f"{end}_airport_lat"),
            F.col("longitude").cast("double").alias(f"{end}_airport_lon"),
            F.col("tz").alias(f"{end}_tz"),
        )
        flights = (
            flights.join(side, key, "left")
            .withColumn(f"{end}_airport_lat", F.coalesce(f"{end}_airport_lat", F.lit(FALLBACK_LAT)))
            .withColumn(f"{end}_airport_lon", F.coalesce(f"{end}_airport_lon", F.lit(FALLBACK_LON)))
            .withColumn(f"{end}_tz", F.coalesce(f"{end}_tz", F.lit(FALLBACK_ZONE)))
        )
    return flights


def correct_times(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Raw flights to corrected flights: UTC times, coordinates, offsets.

    Departure-side times use the origin's zone, arrival-side times the
    destination's.  The stored offsets belong to the last time converted on each
    side (wheels off, arrival), so they are 0 where that time is missing.
    """
    at_origin = ["crs_dep_time", "dep_time", "wheels_off"]
    at_dest = ["wheels_on", "crs_arr_time", "arr_time"]
    # The zone rules are consulted once per side; the clock times only add to that.
    zoned = with_airports(flights, airports).withColumns({
        "dep_midnight": midnight_utc("fl_date", "dep_tz"),
        "arr_midnight": midnight_utc("fl_date", "arr_tz"),
    })
    utc = {c: utc_time("dep_midnight", c) for c in at_origin}
    utc |= {c: utc_time("arr_midnight", c) for c in at_dest}
    utc["dep_airport_tzoffset"] = utc_offset("fl_date", "dep_midnight", "wheels_off")
    utc["arr_airport_tzoffset"] = utc_offset("fl_date", "arr_midnight", "arr_time")
    late = {c: not_before(c, "dep_time") for c in ["wheels_off", *at_dest]}
    return (
        zoned.withColumns(utc)
        .withColumns(late)
        .select(*schemas.names(schemas.CORRECTED_COLUMNS))
    )
