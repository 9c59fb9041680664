"""Training rows and data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac import schemas
from tarmac.functions.features import ontime_label
from tarmac.functions.predicates import good_event
from tarmac.operators.delays import origin_hour_delay
from tarmac.operators.lookups import select_days, with_departure_average
from tarmac.operators.windows import per_window, with_arrival_average
from tarmac.session import measured


#: The event columns that conditions, averages and training rows read.
EVENT_COLUMNS = (
    "fl_date", "event", "notify_time", "dep_time", "dep_airport_tzoffset", "cancelled", "diverted", "dep_delay",
    "taxi_out", "arr_delay", "distance", "op_unique_carrier", "dep_airport_lat", "dep_airport_lon",
    "arr_airport_lat", "arr_airport_lon", "origin", "dest",
)


def training_rows(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 13 training columns; events without an arrival delay have no label and are dropped.

    Averages not attached yet are null.  Columns named in `keep` follow.
    """
    have = set(events.columns)
    optional = {c: F.col(c) if c in have else F.lit(None).cast("double") for c in ("avg_dep_delay", "avg_arr_delay")}
    source = {
        "ontime": ontime_label(),
        "dep_delay": F.col("dep_delay"),
        "taxiout": F.coalesce("taxi_out", F.lit(0.0)),
        "distance": F.col("distance"),
        **optional,
        "carrier": F.col("op_unique_carrier"),
        "dep_lat": F.col("dep_airport_lat"),
        "dep_lon": F.col("dep_airport_lon"),
        "arr_lat": F.col("arr_airport_lat"),
        "arr_lon": F.col("arr_airport_lon"),
        "origin": F.col("origin"),
        "dest": F.col("dest"),
    }
    extra = [c for c in ("window_start", *keep) if c in have]
    return (
        events.where(F.col("arr_delay").isNotNull())
        .select(*[source[n].alias(n) for n in schemas.names(schemas.TRAINING_COLUMNS)], *extra)
    )


def departure_averages(events: DataFrame, days: DataFrame) -> DataFrame:
    """Mean departure delays of the training days, stored for reuse as a lookup."""
    good = select_days(events.where(good_event()), days)
    return measured(origin_hour_delay(good), "departure-averages")


def with_averages(
    events: DataFrame, averages: DataFrame, mean_over: str = "hour", slice_minutes: int = 5, strict: bool = False,
) -> DataFrame:
    """Good events with both averages attached."""
    good = events.where(good_event())
    return with_departure_average(
        with_arrival_average(good, mean_over, slice_minutes), averages, strict
    )


def dataset(
    events: DataFrame, days: DataFrame, averages: DataFrame, train: bool, mean_over: str = "hour",
) -> DataFrame:
    """Training rows of the training days, or of the others.

    Averages come from all good events, so the day filter goes after them.
    """
    return training_rows(select_days(with_averages(events, averages, mean_over), days, train))


def features_per_window(events: DataFrame, averages: DataFrame, strict: bool = False) -> DataFrame:
    """Training rows once for each of the twelve windows an event is in."""
    good = events.where(good_event())
    return training_rows(with_departure_average(per_window(good), averages, strict))
