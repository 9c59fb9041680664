"""From one row per flight to one row per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tarmac import schemas
from tarmac.functions.text import event_payload, payload_fields


def flight_events(corrected: DataFrame) -> DataFrame:
    """A departed event for a known departure, an arrived event for a known arrival.

    Only the event name is generated per row; everything else stays an ordinary
    column, so a query that needs three columns still reads three.
    """
    happened = F.array_compact(F.array(
        F.when(F.col("dep_time").isNotNull(), "departed"),
        F.when(F.col("arr_time").isNotNull(), "arrived"),
    ))
    arrived = F.col("event") == "arrived"
    columns = [
        F.when(arrived, F.col(c)).alias(c) if c in schemas.UNKNOWN_AT_DEPARTURE else F.col(c)
        for c in schemas.names(schemas.CORRECTED_COLUMNS)
    ]
    return (
        corrected.withColumn("event", F.explode(happened))
        .select(
            *columns, "event",
            F.when(arrived, F.col("arr_time")).otherwise(F.col("dep_time")).alias("notify_time"),
        )
    )


def event_lines(corrected: DataFrame, *keep: str) -> DataFrame:
    """The payload lines of `flight_events`, as `value`, after the columns of `keep`.

    Each field is turned into text once a flight; both events take their line from it.
    """
    names = schemas.names(schemas.CORRECTED_COLUMNS)
    fields = dict(zip(names, payload_fields(schemas.CORRECTED_COLUMNS)))
    texts = corrected.select(*[F.coalesce(t, F.lit("")).alias(f"{n}_text") for n, t in fields.items()], *keep)

    def line(event: str, time: str, unknown: list[str]) -> Column:
        known = [F.lit("") if n in unknown else F.col(f"{n}_text") for n in names]
        return F.when(F.col(f"{time}_text") != "", F.concat_ws(",", *known, F.lit(event), F.col(f"{time}_text")))

    happened = F.array_compact(F.array(
        line("departed", "dep_time", schemas.UNKNOWN_AT_DEPARTURE), line("arrived", "arr_time", []),
    ))
    return texts.select(*keep, F.explode(happened).alias("value"))


def with_payload(events: DataFrame) -> DataFrame:
    """The stored event log: integer sequence ids and the line of all fields."""
    ids = {
        c: F.col(c).try_cast("bigint") for c in ("origin_airport_seq_id", "dest_airport_seq_id")
    }
    return (
        events.withColumn("event_data", event_payload())
        .withColumns(ids)
        .select(*schemas.names(schemas.EVENT_LOG_COLUMNS))
    )
