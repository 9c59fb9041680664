"""Time expressions.  All of them assume a UTC session (see `tarmac.session`)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY = 86400


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def midnight_utc(day, zone) -> Column:
    """The UTC instant at which `day` begins in `zone`."""
    return F.to_utc_timestamp(_col(day).cast("timestamp"), _col(zone))


def utc_time(midnight, hhmm) -> Column:
    """Local `HHMM` text as a UTC timestamp, given the UTC instant of local midnight.

    The clock runs on from midnight, so `2400` is the next day and a
    daylight-saving change during the day does not shift the result.  Missing
    text gives null.
    """
    clock = F.nullif(_col(hhmm), F.lit("")).cast("int")
    elapsed = F.floor(clock / 100) * 3600 + (clock % 100) * 60
    return F.timestamp_seconds(F.unix_timestamp(_col(midnight)) + elapsed)


def utc_offset(day, midnight, hhmm) -> Column:
    """Seconds local time is ahead of UTC at that day's midnight; 0 for missing text."""
    offset = F.unix_timestamp(_col(day).cast("timestamp")) - F.unix_timestamp(_col(midnight))
    present = F.nullif(_col(hhmm), F.lit("")).isNotNull()
    return F.when(present, offset).otherwise(F.lit(0)).cast("double")


def not_before(moment, start) -> Column:
    """`moment`, one day later where it falls before `start`."""
    m, s = _col(moment), _col(start)
    return F.when(m < s, m + F.expr("INTERVAL 24 HOURS")).otherwise(m)


def departure_hour(dep_time="dep_time", offset="dep_airport_tzoffset") -> Column:
    """Two-digit local hour of departure; the offset counts in whole hours."""
    whole_hours = (_col(offset) / 3600).cast("int")
    local = F.timestamp_seconds(F.unix_timestamp(_col(dep_time)) + whole_hours * 3600)
    return F.lpad(F.hour(local).cast("string"), 2, "0")


def event_time(text="notify_time") -> Column:
    return F.to_timestamp(_col(text), "yyyy-MM-dd HH:mm:ss")


def time_text(moment) -> Column:
    return F.date_format(_col(moment), "yyyy-MM-dd HH:mm:ss")


def rfc3339(moment) -> Column:
    return F.date_format(_col(moment), "yyyy-MM-dd'T'HH:mm:ssXXX")


def epoch(moment) -> Column:
    """Whole seconds since 1970 of a timestamp, with or without time zone."""
    return F.unix_timestamp(_col(moment).cast("timestamp"))


def slot(seconds, step: int) -> Column:
    """Start of the `step`-second slot that holds an epoch second."""
    s = _col(seconds)
    return s - F.pmod(s, F.lit(step))
