"""SQL that states the flight tables and their derivatives for the checking engine."""

from __future__ import annotations

from tarmac.sources.sample import CARRIERS, CODES, FIRST_DAY, N_DAYS, ZONES


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _hhmm(minute: str) -> str:
    m = f"(({minute}) % 1440 + 1440) % 1440"
    return (
        f"CASE WHEN {m} = 0 THEN '2400' ELSE lpad((({m}) // 60)::VARCHAR, 2, '0') || "
        f"lpad((({m}) % 60)::VARCHAR, 2, '0') END"
    )


_CANCELLED = "l_quantity = 50"
_DIVERTED = "(l_linenumber = 7 AND l_returnflag = 'R')"
_LANDED = f"(NOT {_CANCELLED} AND NOT {_DIVERTED})"
_LATE = "(l_quantity::BIGINT - 20)"
_LEFT = f"(7 * l_partkey + {_LATE})"
_LANDING = f"({_LEFT} + 30 + 6 * p_size)"
_SWING = "(3 * l_linenumber - 12)"
_BRAND = "regexp_extract(p_brand, '([0-9]+)', 1)::BIGINT"

RAW = f"""
raw AS (
  SELECT (DATE '{FIRST_DAY}' + (l_orderkey % {N_DAYS})::INTEGER)::DATE AS fl_date,
    {_list(CARRIERS)}[{_BRAND} % 16 + 1] AS op_unique_carrier,
    (19000 + {_BRAND})::VARCHAR AS op_carrier_airline_id,
    {_list(CARRIERS)}[{_BRAND} % 16 + 1] AS op_carrier,
    l_partkey::VARCHAR AS op_carrier_fl_num,
    (10000 + s_nationkey)::VARCHAR AS origin_airport_id,
    (1000001 + 100 * s_nationkey)::VARCHAR AS origin_airport_seq_id,
    (30000 + s_nationkey)::VARCHAR AS origin_city_market_id,
    {_list(CODES)}[s_nationkey + 1] AS origin,
    (10000 + c_nationkey)::VARCHAR AS dest_airport_id,
    (1000001 + 100 * c_nationkey)::VARCHAR AS dest_airport_seq_id,
    (30000 + c_nationkey)::VARCHAR AS dest_city_market_id,
    {_list(CODES)}[c_nationkey + 1] AS dest,
    {_hhmm('7 * l_partkey')} AS crs_dep_time,
    CASE WHEN NOT {_CANCELLED} OR l_linenumber % 2 = 0 THEN {_hhmm(_LEFT)} END AS dep_time,
    CASE WHEN NOT {_CANCELLED} THEN {_LATE}::DOUBLE END AS dep_delay,
    CASE WHEN NOT {_CANCELLED} THEN (3 * l_linenumber + 5)::DOUBLE END AS taxi_out,
    CASE WHEN NOT {_CANCELLED} THEN {_hhmm(f'{_LEFT} + 3 * l_linenumber + 5')} END AS wheels_off,
    CASE WHEN {_LANDED} THEN {_hhmm(f'{_LANDING} - l_linenumber - 2')} END AS wheels_on,
    CASE WHEN {_LANDED} THEN (l_linenumber + 2)::DOUBLE END AS taxi_in,
    {_hhmm(f'{_LANDING} - {_LATE} - {_SWING}')} AS crs_arr_time,
    CASE WHEN NOT {_CANCELLED} AND (NOT {_DIVERTED} OR l_linestatus = 'O')
      THEN {_hhmm(_LANDING)} END AS arr_time,
    CASE WHEN {_LANDED} THEN ({_LATE} + {_SWING})::DOUBLE END AS arr_delay,
    CASE WHEN {_CANCELLED} THEN '1.00' ELSE '0.00' END AS cancelled,
    CASE WHEN {_CANCELLED} THEN 'A' END AS cancellation_code,
    CASE WHEN {_DIVERTED} AND NOT {_CANCELLED} THEN '1.00' ELSE '0.00' END AS diverted,
    (50 * p_size)::DOUBLE AS distance,
    l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey AS flight_key
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
)"""

DAYS = f"""
days AS (
  SELECT (DATE '{FIRST_DAY}' + d::INTEGER)::DATE AS fl_date, d % 10 < 7 AS is_train_day
  FROM range({N_DAYS}) AS r(d)
)"""

AIRPORTS = f"""
airports AS (
  SELECT (1000001 + 100 * n_nationkey)::VARCHAR AS airport_seq_id,
    CASE WHEN n_nationkey < 24 THEN 20 + 1.25 * n_nationkey::DOUBLE END AS latitude,
    CASE WHEN n_nationkey < 24 THEN -120 + 2.0 * n_nationkey::DOUBLE END AS longitude,
    {_list(CODES)}[n_nationkey + 1] AS code,
    CASE WHEN n_nationkey % 10 = 7 THEN 'UTC' ELSE {_list(ZONES)}[n_nationkey % 5 + 1] END AS tz
  FROM nation
)"""


def _utc(column: str, midnight: str) -> str:
    minutes = f"substr({column}, 1, 2)::BIGINT * 60 + substr({column}, 3, 2)::BIGINT"
    return f"{midnight} + to_minutes({minutes})"


def _next_day(column: str) -> str:
    return f"CASE WHEN {column} < dep_time THEN {column} + INTERVAL 24 HOUR ELSE {column} END AS {column}"


CORRECTED = f"""{RAW},{AIRPORTS},
known AS (SELECT * FROM airports WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
placed AS (
  SELECT raw.*,
    coalesce(o.latitude, 37.52) AS dep_airport_lat, coalesce(o.longitude, -92.17) AS dep_airport_lon,
    coalesce(d.latitude, 37.52) AS arr_airport_lat, coalesce(d.longitude, -92.17) AS arr_airport_lon,
    timezone('UTC', timezone(coalesce(o.tz, 'America/Chicago'), fl_date::TIMESTAMP)) AS dep_midnight,
    timezone('UTC', timezone(coalesce(d.tz, 'America/Chicago'), fl_date::TIMESTAMP)) AS arr_midnight
  FROM raw
  LEFT JOIN known o ON origin_airport_seq_id = o.airport_seq_id
  LEFT JOIN known d ON dest_airport_seq_id = d.airport_seq_id
),
utc AS (
  SELECT * REPLACE (
      {_utc('crs_dep_time', 'dep_midnight')} AS crs_dep_time,
      {_utc('dep_time', 'dep_midnight')} AS dep_time,
      {_utc('wheels_off', 'dep_midnight')} AS wheels_off,
      {_utc('wheels_on', 'arr_midnight')} AS wheels_on,
      {_utc('crs_arr_time', 'arr_midnight')} AS crs_arr_time,
      {_utc('arr_time', 'arr_midnight')} AS arr_time),
    CASE WHEN wheels_off IS NULL THEN 0
      ELSE epoch(fl_date::TIMESTAMP) - epoch(dep_midnight) END::DOUBLE AS dep_airport_tzoffset,
    CASE WHEN arr_time IS NULL THEN 0
      ELSE epoch(fl_date::TIMESTAMP) - epoch(arr_midnight) END::DOUBLE AS arr_airport_tzoffset
  FROM placed
),
corrected AS (
  SELECT * REPLACE (
    {_next_day('wheels_off')}, {_next_day('wheels_on')},
    {_next_day('crs_arr_time')}, {_next_day('arr_time')})
  FROM utc
)"""

EVENTS = f"""{CORRECTED},
events_log AS (
  SELECT * REPLACE (
      NULL::DOUBLE AS taxi_out, NULL::TIMESTAMP AS wheels_off, NULL::TIMESTAMP AS wheels_on,
      NULL::DOUBLE AS taxi_in, NULL::TIMESTAMP AS arr_time, NULL::DOUBLE AS arr_delay,
      NULL::VARCHAR AS diverted),
    'departed' AS event, dep_time AS notify_time
  FROM corrected WHERE dep_time IS NOT NULL
  UNION ALL
  SELECT *, 'arrived' AS event, arr_time AS notify_time FROM corrected WHERE arr_time IS NOT NULL
)"""

DEP_HOUR = "strftime(dep_time + to_hours(trunc(dep_airport_tzoffset / 3600)::BIGINT), '%H')"
SLOT = "(epoch(notify_time)::BIGINT // 300) * 300"

GOOD = f"""{EVENTS},{DAYS},
good AS (
  SELECT *, {DEP_HOUR} AS dep_hour, {SLOT} AS slot FROM events_log
  WHERE (event = 'departed' AND cancelled = '0.00') OR (event = 'arrived' AND diverted = '0.00')
)"""

AVERAGES = f"""{GOOD},
dep_avg AS (
  SELECT origin, dep_hour, avg(dep_delay + taxi_out) AS avg_dep_delay
  FROM good JOIN days USING (fl_date) WHERE is_train_day AND event = 'arrived'
  GROUP BY origin, dep_hour
),
arr_avg AS (
  SELECT g.dest, g.slot, avg(a.arr_delay) AS avg_arr_delay
  FROM (SELECT DISTINCT dest, slot FROM good) g
  JOIN (SELECT dest, slot, arr_delay FROM good WHERE event = 'arrived') a
    ON a.dest = g.dest AND a.slot BETWEEN g.slot - 3300 AND g.slot
  GROUP BY g.dest, g.slot
),
featured AS (
  SELECT good.*, coalesce(dep_avg.avg_dep_delay, 0) AS avg_dep_delay,
    coalesce(arr_avg.avg_arr_delay, 0) AS avg_arr_delay
  FROM good
  LEFT JOIN dep_avg ON dep_avg.origin = good.origin AND dep_avg.dep_hour = good.dep_hour
  LEFT JOIN arr_avg ON arr_avg.dest = good.dest AND arr_avg.slot = good.slot
),
training AS (
  SELECT fl_date, (arr_delay < 15)::INTEGER::DOUBLE AS ontime, dep_delay, coalesce(taxi_out, 0) AS taxiout,
    distance, round(avg_dep_delay, 6) AS avg_dep_delay, round(avg_arr_delay, 6) AS avg_arr_delay,
    op_unique_carrier AS carrier, dep_airport_lat AS dep_lat, dep_airport_lon AS dep_lon,
    arr_airport_lat AS arr_lat, arr_airport_lon AS arr_lon, origin, dest
  FROM featured WHERE arr_delay IS NOT NULL
)"""


def text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def with_raw(select: str) -> str:
    return f"WITH {RAW},{DAYS} {select}"


def with_corrected(select: str) -> str:
    return f"WITH {CORRECTED} {select}"


def with_events(select: str) -> str:
    return f"WITH {EVENTS},{DAYS} {select}"


def with_averages(select: str) -> str:
    return f"WITH {AVERAGES} {select}"
