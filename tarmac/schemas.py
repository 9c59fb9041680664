"""Record shapes of the flight data, from raw monthly file to stored prediction."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the published on-time data and of the
# tables derived from it.
RAW_COLUMNS = [
    ("fl_date", "date"),
    ("op_unique_carrier", "string"),
    ("op_carrier_airline_id", "string"),
    ("op_carrier", "string"),
    ("op_carrier_fl_num", "string"),
    ("origin_airport_id", "string"),
    ("origin_airport_seq_id", "string"),
    ("origin_city_market_id", "string"),
    ("origin", "string"),
    ("dest_airport_id", "string"),
    ("dest_airport_seq_id", "string"),
    ("dest_city_market_id", "string"),
    ("dest", "string"),
    ("crs_dep_time", "string"),
    ("dep_time", "string"),
    ("dep_delay", "double"),
    ("taxi_out", "double"),
    ("wheels_off", "string"),
    ("wheels_on", "string"),
    ("taxi_in", "double"),
    ("crs_arr_time", "string"),
    ("arr_time", "string"),
    ("arr_delay", "double"),
    ("cancelled", "string"),
    ("cancellation_code", "string"),
    ("diverted", "string"),
    ("distance", "double"),
]
AIRPORT_COLUMNS = [
    ("dep_airport_lat", "double"),
    ("dep_airport_lon", "double"),
    ("dep_airport_tzoffset", "double"),
    ("arr_airport_lat", "double"),
    ("arr_airport_lon", "double"),
    ("arr_airport_tzoffset", "double"),
]
EVENT_COLUMNS = [("event", "string"), ("notify_time", "timestamp")]
TIME_COLUMNS = ["crs_dep_time", "dep_time", "wheels_off", "wheels_on", "crs_arr_time", "arr_time"]
# Unknown at departure, hence empty on a departed event.
UNKNOWN_AT_DEPARTURE = [
    "taxi_out", "wheels_off", "wheels_on", "taxi_in", "arr_time", "arr_delay", "diverted",
]
TRAINING_COLUMNS = [
    ("ontime", "double"),
    ("dep_delay", "double"),
    ("taxiout", "double"),
    ("distance", "double"),
    ("avg_dep_delay", "double"),
    ("avg_arr_delay", "double"),
    ("carrier", "string"),
    ("dep_lat", "double"),
    ("dep_lon", "double"),
    ("arr_lat", "double"),
    ("arr_lon", "double"),
    ("origin", "string"),
    ("dest", "string"),
]
# Positions of the used columns in the airport master file.
AIRPORT_FILE_POSITIONS = {"airport_seq_id": 0, "latitude": 21, "longitude": 26}


TYPES = {
    "date": T.DateType(), "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
}


def struct(columns: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in columns])


def names(columns: list[tuple[str, str]]) -> list[str]:
    return [name for name, _ in columns]


def _with_utc_times(columns: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return [(n, "timestamp" if n in TIME_COLUMNS else k) for n, k in columns]


RAW_FLIGHT = struct(RAW_COLUMNS)
CORRECTED_COLUMNS = _with_utc_times(RAW_COLUMNS) + AIRPORT_COLUMNS
EVENT_ROW_COLUMNS = CORRECTED_COLUMNS + EVENT_COLUMNS
FLIGHT_EVENT = struct(EVENT_ROW_COLUMNS)
# The stored event table types both sequence ids as integers.
EVENT_LOG_COLUMNS = [
    (n, "bigint" if n.endswith("airport_seq_id") else k) for n, k in EVENT_ROW_COLUMNS
] + [("event_data", "string")]
DELAY_LOOKUP = struct([("origin_hour", "string"), ("avg_dep_delay", "double")])
TRAINING_ROW = struct(TRAINING_COLUMNS)
PREDICTION_COLUMNS = [
    (n, "bigint" if n.endswith("airport_seq_id") else k) for n, k in EVENT_ROW_COLUMNS
] + [("ontime", "double")]

RAW_HEADER = ",".join(n.upper() for n in names(RAW_COLUMNS))

# Warehouse type names found in JSON table schemas, with their Spark types.
WAREHOUSE_TYPES = {
    "DATE": "date",
    "STRING": "string",
    "INTEGER": "bigint",
    "FLOAT": "double",
    "TIMESTAMP": "timestamp",
    "DATETIME": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def from_json_fields(fields: list[dict]) -> T.StructType:
    """A list of `{name, type, mode}` field objects as a StructType."""
    return T.StructType([
        T.StructField(
            f["name"].lower(),
            TYPES[WAREHOUSE_TYPES[f["type"]]],
            f.get("mode", "NULLABLE") != "REQUIRED",
        )
        for f in fields
    ])
