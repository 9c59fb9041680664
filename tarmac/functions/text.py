"""Line and payload expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tarmac import schemas
from tarmac.functions.times import time_text

# Decimals each numeric field carries in event payloads.
PAYLOAD_DECIMALS = {
    "dep_delay": 2, "taxi_out": 2, "taxi_in": 2, "arr_delay": 2, "distance": 2,
    "dep_airport_lat": 8, "dep_airport_lon": 8, "dep_airport_tzoffset": 1,
    "arr_airport_lat": 8, "arr_airport_lon": 8, "arr_airport_tzoffset": 1,
}


def clean_line(line) -> Column:
    """Drop trailing white space, then trailing commas, then every double quote."""
    line = F.col(line) if isinstance(line, str) else line
    bare = F.regexp_replace(F.regexp_replace(line, r"\s+$", ""), r",+$", "")
    return F.replace(bare, F.lit('"'), F.lit(""))


def field_count(line) -> Column:
    """Number of comma-separated fields, trailing empty ones left out."""
    line = F.col(line) if isinstance(line, str) else line
    return F.size(F.split(F.regexp_replace(line, r",+$", ""), ",", -1))


def fixed(column, decimals: int) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(f"decimal(20,{decimals})").cast("string")


def csv_line(*columns) -> Column:
    """Values joined by commas; a null is an empty field."""
    texts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws(",", *[F.coalesce(t.cast("string"), F.lit("")) for t in texts])


def payload_fields(columns: list[tuple[str, str]]) -> list[Column]:
    """Each column as the text it has inside a payload line."""
    out = []
    for name, kind in columns:
        if name in PAYLOAD_DECIMALS:
            out.append(fixed(name, PAYLOAD_DECIMALS[name]).alias(name))
        elif kind == "timestamp":
            out.append(time_text(name).alias(name))
        else:
            out.append(F.col(name).cast("string").alias(name))
    return out


def event_payload() -> Column:
    """The 35 event fields as one comma-separated line."""
    return csv_line(*payload_fields(schemas.EVENT_ROW_COLUMNS))


def typed_fields(line, columns: list[tuple[str, str]], wanted=None) -> Column:
    """A payload line as a struct of typed columns; empty or unreadable text becomes null.

    With `wanted`, the line is split once and only the named fields are cast.
    """
    line = F.col(line) if isinstance(line, str) else line
    if wanted is not None:
        texts = F.split(line, ",", -1)
        place = {name: (i, kind) for i, (name, kind) in enumerate(columns)}
        return F.struct(*[
            F.nullif(F.get(texts, F.lit(place[n][0])), F.lit("")).try_cast(place[n][1]).alias(n) for n in wanted
        ])
    ddl = ", ".join(f"{name} {kind}" for name, kind in columns)
    return F.from_csv(line, ddl, {"mode": "PERMISSIVE", "nullValue": "", "quote": ""})


def stamped(line, moment=None) -> Column:
    """`yyyy-MM-dd HH:mm:ss line`, stamped with the processing time by default."""
    line = F.col(line) if isinstance(line, str) else line
    return F.concat_ws(" ", time_text(F.current_timestamp() if moment is None else moment), line)
