"""Flight tables derived from the order tables used for testing.

No airline data comes with the test tables, so every order line is read as one
flight: the supplier's nation is the origin, the customer's the destination, the
part gives carrier and distance, quantity and line number give the delays.  Only
the joins the requested columns need are made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac import schemas
from tarmac.functions.predicates import has_coordinates
from tarmac.operators.correction import correct_times, with_timezone
from tarmac.operators.events import flight_events
from tarmac.session import measured

# Fixed values shared with the checking SQL.
FIRST_DAY = "2018-02-01"
N_DAYS = 60
CODES = [
    "ATL", "ORD", "DFW", "DEN", "LAX", "SFO", "PHX", "IAH", "LAS", "MSP", "MCO", "SEA", "DTW",
    "BOS", "EWR", "CLT", "LGA", "SLC", "JFK", "BWI", "MDW", "DCA", "FLL", "MIA", "SAN",
]
ZONES = [
    "America/New_York", "America/Chicago", "America/Denver", "America/Phoenix", "America/Los_Angeles",
]
CARRIERS = [
    "AS", "VX", "F9", "UA", "US", "WN", "HA", "EV", "MQ", "DL", "OO", "B6", "NK", "AA", "YX", "9E",
]


# Columns used of each test table; naming them saves a job that reads the footers.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_returnflag string, l_linestatus string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_brand string, p_size int",
    "nation": "n_nationkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: str) -> str:
    return f"get(split('{','.join(values)}', ','), cast({index} AS int))"


def _hhmm(minute: str) -> str:
    """Minute of the day as HHMM; midnight is written 2400."""
    m = f"(pmod({minute} - 1, 1440) + 1)"
    return f"lpad(cast({m} + 40 * ({m} div 60) AS string), 4, '0')"


_CANCELLED = "(l_quantity = 50)"
_DIVERTED = "(l_linenumber = 7 AND l_returnflag = 'R')"
_LATE = "cast(l_quantity - 20 AS int)"
_SWING = "(3 * l_linenumber - 12)"
_LEFT = f"(l_partkey * 7 + {_LATE})"
_LANDING = f"({_LEFT} + 30 + 6 * p_size)"
_FLEW = f"NOT {_CANCELLED}"
_LANDED = f"(NOT {_CANCELLED} AND NOT {_DIVERTED})"
# Some cancelled flights had left the gate, some diverted ones landed late.
_LEFT_GATE = f"(NOT {_CANCELLED} OR l_linenumber % 2 = 0)"
_TOUCHED_DOWN = f"(NOT {_CANCELLED} AND (NOT {_DIVERTED} OR l_linestatus = 'O'))"

FLIGHT_COLUMNS = {
    "fl_date": f"date_add(DATE '{FIRST_DAY}', cast(l_orderkey % {N_DAYS} AS int))",
    "op_unique_carrier": _pick(CARRIERS, "brand % 16"),
    "op_carrier_airline_id": "cast(19000 + brand AS string)",
    "op_carrier": _pick(CARRIERS, "brand % 16"),
    "op_carrier_fl_num": "cast(l_partkey AS string)",
    "origin_airport_id": "cast(10000 + s_nationkey AS string)",
    "origin_airport_seq_id": "cast(1000001 + 100 * s_nationkey AS string)",
    "origin_city_market_id": "cast(30000 + s_nationkey AS string)",
    "origin": _pick(CODES, "s_nationkey"),
    "dest_airport_id": "cast(10000 + c_nationkey AS string)",
    "dest_airport_seq_id": "cast(1000001 + 100 * c_nationkey AS string)",
    "dest_city_market_id": "cast(30000 + c_nationkey AS string)",
    "dest": _pick(CODES, "c_nationkey"),
    "crs_dep_time": _hhmm("l_partkey * 7"),
    "dep_time": f"CASE WHEN {_LEFT_GATE} THEN {_hhmm(_LEFT)} END",
    "dep_delay": f"CASE WHEN {_FLEW} THEN cast({_LATE} AS double) END",
    "taxi_out": f"CASE WHEN {_FLEW} THEN cast(3 * l_linenumber + 5 AS double) END",
    "wheels_off": f"CASE WHEN {_FLEW} THEN {_hhmm(f'{_LEFT} + 3 * l_linenumber + 5')} END",
    "wheels_on": f"CASE WHEN {_LANDED} THEN {_hhmm(f'{_LANDING} - l_linenumber - 2')} END",
    "taxi_in": f"CASE WHEN {_LANDED} THEN cast(l_linenumber + 2 AS double) END",
    "crs_arr_time": _hhmm(f"{_LANDING} - {_LATE} - {_SWING}"),
    "arr_time": f"CASE WHEN {_TOUCHED_DOWN} THEN {_hhmm(_LANDING)} END",
    "arr_delay": f"CASE WHEN {_LANDED} THEN cast({_LATE} + {_SWING} AS double) END",
    "cancelled": f"CASE WHEN {_CANCELLED} THEN '1.00' ELSE '0.00' END",
    "cancellation_code": f"CASE WHEN {_CANCELLED} THEN 'A' END",
    "diverted": f"CASE WHEN {_DIVERTED} AND {_FLEW} THEN '1.00' ELSE '0.00' END",
    "distance": "cast(50 * p_size AS double)",
    "flight_key": "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)",
}
FROM_PART = {
    "op_unique_carrier", "op_carrier", "op_carrier_airline_id", "distance", "wheels_on", "crs_arr_time", "arr_time",
}


def flights(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """Raw flights with the wanted columns, all 27 by default.

    `flight_key` may be asked for as well: a text made of the four order keys.
    """
    wanted = wanted or tuple(schemas.names(schemas.RAW_COLUMNS))
    out = table(spark, sf_dir, "lineitem")
    if FROM_PART.intersection(wanted):
        parts = table(spark, sf_dir, "part").selectExpr(
            "p_partkey AS l_partkey", "cast(regexp_extract(p_brand, '([0-9]+)', 1) AS int) AS brand", "p_size")
        out = out.join(parts, "l_partkey", "left")
    if any(w.startswith("origin") for w in wanted):
        suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
        out = out.join(suppliers, "l_suppkey", "left")
    if any(w.startswith("dest") for w in wanted):
        customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
        orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
        owner = orders.join(customers, "o_custkey", "left").drop("o_custkey")
        out = out.join(owner, "l_orderkey", "left")
    return out.selectExpr(*[f"{FLIGHT_COLUMNS[w]} AS {w}" for w in wanted])


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport master: one airport per nation; the last one has no coordinates."""
    return table(spark, sf_dir, "nation").selectExpr(
        "cast(1000001 + 100 * n_nationkey AS string) AS airport_seq_id",
        "CASE WHEN n_nationkey < 24 THEN cast(20 + 1.25 * n_nationkey AS double) END AS latitude",
        "CASE WHEN n_nationkey < 24 THEN cast(-120 + 2.0 * n_nationkey AS double) END AS longitude",
        f"{_pick(CODES, 'n_nationkey')} AS code",
    )


def airport_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport to time zone; every tenth airport is missing."""
    return table(spark, sf_dir, "nation").where("n_nationkey % 10 <> 7").selectExpr(
        "cast(1000001 + 100 * n_nationkey AS string) AS airport_seq_id",
        f"{_pick(ZONES, 'n_nationkey % 5')} AS tz",
    )


def train_days(spark: SparkSession) -> DataFrame:
    """Calendar of the flight days: seven of every ten days train."""
    return spark.range(0, N_DAYS, 1, 1).selectExpr(
        f"date_add(DATE '{FIRST_DAY}', cast(id AS int)) AS fl_date", "id % 10 < 7 AS is_train_day")


def zoned_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_timezone(airports(spark, sf_dir).where(has_coordinates()), airport_zones(spark, sf_dir))


def corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correct_times(flights(spark, sf_dir), zoned_airports(spark, sf_dir))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flight_events(corrected(spark, sf_dir))


def stored_events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The event log with the named columns, stored: for jobs that read it several times."""
    return measured(event_log(spark, sf_dir).select(*columns), "events")
