"""Row keys and key-based sampling."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LONG_MAX = 2**63 - 1


def newest_first_key() -> Column:
    """`ORIGIN#DEST#CARRIER#n` where later scheduled departures sort first."""
    reverse = F.lit(LONG_MAX) - F.unix_millis("crs_dep_time")
    return F.concat_ws("#", "origin", "dest", "op_carrier", reverse.cast("string"))


def hash_fraction(*columns) -> Column:
    """A number in [0, 1) that depends on the key alone, the same on every engine."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(2**32)


def keep_fraction(fraction: float, *columns) -> Column:
    return hash_fraction(*columns) < fraction


def hash_bucket(column, size: int) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.xxhash64(column), F.lit(size)).cast("int")
