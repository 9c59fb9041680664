"""From the event log to training files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac.functions import predicates as P
from tarmac.operators import training
from tarmac.operators.delays import delay_lines, origin_hour_delay
from tarmac.operators.lookups import select_days, with_departure_average
from tarmac.session import measured
from tarmac.sinks.files import write_csv, write_keyed_csv
from tarmac.sources.files import parse_events


def _parsed(lines: DataFrame) -> DataFrame:
    return parse_events(lines, columns=training.EVENT_COLUMNS)


def strict_training_csv(lines: DataFrame, out: str) -> None:
    """Training rows of arrivals that were neither cancelled nor diverted."""
    write_csv(training.training_rows(_parsed(lines).where(P.good_arrival())), out)


def hourly_averages(lines: DataFrame, out: str) -> None:
    """`ORIGIN:HH,mean` of all good events in a set of payload lines."""
    good = _parsed(lines).where(P.good_event())
    write_averages(origin_hour_delay(good), out)


def training_day_events(lines: DataFrame, days: DataFrame) -> DataFrame:
    return select_days(parse_events(lines), days)


def day_to_training(log: DataFrame, day: str, out: str, carrier: str | None = None) -> None:
    """One day of the log to training rows and hourly averages."""
    good = measured(log.where(P.on_day(day, carrier=carrier)).where(P.good_event()), "day")
    write_csv(training.training_rows(good), f"{out}/train")
    write_averages(origin_hour_delay(good), f"{out}/delays")


def departure_features(lines: DataFrame) -> DataFrame:
    """Training rows with the departure average computed from the same events."""
    good = _parsed(lines).where(P.good_event())
    averages = measured(origin_hour_delay(good), "departure-averages")
    return training.training_rows(with_departure_average(good, averages))


def full_features(
    log: DataFrame, days: DataFrame, out: str, strict: bool = False, per_window: bool = False,
) -> None:
    """Both averages, computed and attached on the training days only.

    `strict` turns a missing departure average into an error, `per_window` gives
    each event once per window that holds it.
    """
    events = select_days(log, days)
    averages = training.departure_averages(events, days)
    if per_window:
        rows = training.features_per_window(events, averages, strict)
    else:
        rows = training.training_rows(training.with_averages(events, averages, strict=strict))
    write_csv(rows, out)


def train_and_test(
    log: DataFrame, days: DataFrame, out: str, cutoff: str | None = None, mean_over: str = "hour",
    slice_minutes: int = 5,
) -> None:
    """Training set, test set and departure averages, over the whole log or up to a day.

    The training rows and their day are stored once and split by day from there.
    """
    events = log.where(P.up_to(cutoff))
    averages = training.departure_averages(events, days)
    write_averages(averages, f"{out}/delays")
    enriched = training.with_averages(events, averages, mean_over, slice_minutes)
    rows = measured(training.training_rows(enriched, keep=("fl_date",)), "training-rows")
    for name, train in (("train", True), ("test", False)):
        write_csv(select_days(rows, days, train).drop("fl_date"), f"{out}/{name}")


def write_averages(averages: DataFrame, out: str) -> None:
    """One row per origin and hour, in one file."""
    lines = delay_lines(averages)
    key = F.split("value", ",")
    write_keyed_csv(lines.select(key[0].alias("origin_hour"), key[1].alias("avg_dep_delay")), out)
