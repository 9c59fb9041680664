"""Row conditions.  A null operand makes a condition null, which `where` drops."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ZERO = "0.00"


def contains(text: str, column: str = "value") -> Column:
    return F.col(column).contains(text)


def has_coordinates(lat: str = "latitude", lon: str = "longitude") -> Column:
    return F.col(lat).isNotNull() & F.col(lon).isNotNull()


def is_departed() -> Column:
    return F.col("event") == "departed"


def is_arrived() -> Column:
    return F.col("event") == "arrived"


def not_cancelled() -> Column:
    return F.col("cancelled") == ZERO


def not_diverted() -> Column:
    return F.col("diverted") == ZERO


def flown() -> Column:
    return not_cancelled() & not_diverted()


def has_delays() -> Column:
    return F.col("dep_delay").isNotNull() & F.col("arr_delay").isNotNull()


def good_event() -> Column:
    """Departed and not cancelled, or arrived and not diverted."""
    return (is_departed() & not_cancelled()) | (is_arrived() & not_diverted())


def good_arrival() -> Column:
    """The strict form: arrived, neither cancelled nor diverted."""
    return flown() & is_arrived()


def successful_event() -> Column:
    """An event whose delays are known as far as they can be at its time."""
    left = is_departed() & not_cancelled() & F.col("dep_delay").isNotNull()
    landed = is_arrived() & flown() & has_delays()
    return left | landed


def rejected(condition: Column) -> Column:
    """Rows for which a condition is false or unknown."""
    return ~F.coalesce(condition, F.lit(False))


def one_of(column: str, values) -> Column:
    return F.col(column).isin(*values)


def in_half_open(column: str, start, end) -> Column:
    return (F.col(column) >= start) & (F.col(column) < end)


def on_day(day: str, events=("departed", "arrived"), carrier: str | None = None) -> Column:
    cond = (F.col("fl_date") == F.to_date(F.lit(day))) & one_of("event", events)
    return cond if carrier is None else cond & (F.col("op_unique_carrier") == carrier)


def up_to(day: str | None, events=("departed", "arrived")) -> Column:
    """Events of the given kinds, up to a cut-off day unless that is None."""
    cond = one_of("event", events)
    return cond if day is None else (F.col("fl_date") <= F.to_date(F.lit(day))) & cond


def probability_band(column: str = "probability", low: float = 0.65, high: float = 0.75) -> Column:
    return (F.col(column) > low) & (F.col(column) < high)
