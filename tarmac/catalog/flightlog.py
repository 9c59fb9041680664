"""Cleaning, time correction, event log, lookups, windows and training sets."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tarmac import schemas
from tarmac.catalog.checksql import (
    AIRPORTS, DEP_HOUR, SLOT, text, with_averages, with_corrected, with_events, with_raw,
)
from tarmac.catalog.registry import checksum, checksum_sql, query, rounded
from tarmac.functions import predicates as P
from tarmac.functions.text import clean_line, csv_line, event_payload, field_count, fixed
from tarmac.functions.times import departure_hour, time_text
from tarmac.operators import correction, delays, lookups, training, windows, zones
from tarmac.operators.events import event_lines
from tarmac.session import measured
from tarmac.sources import files, sample, tables

EVENT_KEY = "op_carrier_fl_num"


def _texts(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: time_text(c) for c in columns})


# --- cleaning -----------------------------------------------------------------

def raw_lines(spark, sf) -> DataFrame:
    """Raw flights as delivered: names quoted, a trailing comma on every line."""
    flights = sample.flights(spark, sf)
    parts = []
    for name, kind in schemas.RAW_COLUMNS:
        if kind == "double":
            parts.append(fixed(name, 2))
        elif name in ("op_unique_carrier", "origin", "dest", "cancellation_code"):
            parts.append(F.concat(F.lit('"'), F.coalesce(name, F.lit("")), F.lit('"')))
        else:
            parts.append(F.col(name))
    return flights.select("op_unique_carrier", F.concat(csv_line(*parts), F.lit(",,  ")).alias("value"))


#: Own rough outlines, one of them with a bay, two of them overlapping.
OUTLINES = {
    "America/Chicago": [(-104, 26), (-87, 29.5), (-85.5, 46), (-97, 42), (-103.5, 49)],
    "America/Denver": [(-114, 31.3), (-103, 31), (-101.2, 49), (-116.1, 49), (-111, 40.5)],
    "America/Los_Angeles": [(-124.5, 40), (-117, 32.2), (-114, 35), (-114, 42), (-117, 49), (-124.7, 48.4)],
    "America/New_York": [(-87.5, 30), (-80, 24.5), (-67, 45), (-88.4, 48), (-84, 38.2)],
}
_PLACE_SQL = """SELECT c_custkey, 22 + (c_custkey * 104729 % 30011) / 1000.0::DOUBLE AS y, -126 + (c_custkey * 7919 % 60013) / 1000.0::DOUBLE AS x FROM customer"""


@query("coordinate_timezones", f"""
WITH place AS ({_PLACE_SQL}), ring(zone, i, x1, y1, x2, y2) AS (VALUES {", ".join(
    f"('{zone}', {i}, {x}::DOUBLE, {y}::DOUBLE, {ring[(i + 1) % len(ring)][0]}::DOUBLE, {ring[(i + 1) % len(ring)][1]}::DOUBLE)"
    for zone, ring in OUTLINES.items() for i, (x, y) in enumerate(ring))}
), held AS (
  SELECT c_custkey, zone FROM place, ring WHERE ((y1 > y) <> (y2 > y)) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
  GROUP BY c_custkey, zone HAVING count(*) % 2 = 1
)
SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 'TIMEZONE' ELSE coalesce(min(zone), 'UTC') END AS tz
FROM customer LEFT JOIN held USING (c_custkey) GROUP BY c_custkey""")
def coordinate_timezones(spark, sf):
    """Places spread over a map, each in the zone whose outline holds it."""
    key = F.col("c_custkey")
    places = sample.table(spark, sf, "customer").select(
        "c_custkey", (22 + (key * 104729 % 30011) / 1000.0).cast("string").alias("latitude"),
        F.when(key % 50 == 0, "unknown").otherwise((-126 + (key * 7919 % 60013) / 1000.0).cast("string")).alias("longitude"))
    polygons = spark.createDataFrame(
        [(zone, [(float(x), float(y)) for x, y in ring]) for zone, ring in OUTLINES.items()], "zone string, ring array<struct<x:double,y:double>>")
    return zones.with_zone(places, measured(zones.grid(polygons), "zones")).select("c_custkey", "tz")


def _raw_line_sql(quoted: bool) -> str:
    out = []
    for name, kind in schemas.RAW_COLUMNS:
        if kind == "double":
            out.append(f"coalesce({name}::DECIMAL(20,2)::VARCHAR, '')")
        elif name in ("op_unique_carrier", "origin", "dest", "cancellation_code") and quoted:
            out.append(f"'\"' || coalesce({name}, '') || '\"'")
        else:
            out.append(f"coalesce({name}::VARCHAR, '')")
    return "concat_ws(',', " + ", ".join(out) + ")"


@query("clean_lines", with_raw(f"SELECT {_raw_line_sql(False)} AS value FROM raw"))
def clean_lines(spark, sf):
    return files.clean_lines(raw_lines(spark, sf).select("value"))


def delivered_files(spark, sf) -> DataFrame:
    """Lines of one file per carrier; one file has another header, and one came empty and then again with its flights."""
    carrier = F.col("op_unique_carrier")
    flights = raw_lines(spark, sf).select(
        F.concat(F.lit("raw/"), carrier, F.when(carrier == "AA", "-again").otherwise(""), F.lit(".csv")).alias("path"),
        F.lit(1).cast("bigint").alias("line_no"), clean_line("value").alias("value"),
    )
    paths = flights.select("path").distinct()
    paths = paths.unionByName(paths.where("path = 'raw/AA-again.csv'").select(F.lit("raw/AA.csv").alias("path")))
    heads = paths.select(
        "path", F.lit(0).cast("bigint").alias("line_no"),
        F.when(F.col("path") == "raw/F9.csv", "YEAR,MONTH").otherwise(schemas.RAW_HEADER).alias("value"),
    )
    return heads.unionByName(flights)


@query("header_check", with_raw(f"""
SELECT 'raw/' || op_unique_carrier || CASE op_unique_carrier WHEN 'AA' THEN '-again' ELSE '' END || '.csv' AS path, count(*) + 1 AS n_lines,
  CASE op_unique_carrier WHEN 'F9' THEN 'unexpected_format' ELSE 'ok' END AS verdict
FROM raw GROUP BY op_unique_carrier
UNION ALL SELECT DISTINCT 'raw/AA.csv', 1, 'data_unavailable' FROM raw WHERE op_unique_carrier = 'AA'"""))
def header_check(spark, sf):
    return files.file_report(delivered_files(spark, sf)).select("path", "n_lines", "verdict")


@query("next_month", """
SELECT strftime(max(o_orderdate), '%Y%m') AS latest,
  strftime(date_trunc('month', max(o_orderdate)) + INTERVAL 1 MONTH, '%Y%m') AS next FROM orders""")
def next_month(spark, sf):
    orders = sample.table(spark, sf, "orders")
    paths = orders.select(
        F.concat(F.lit("flights/raw/"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".csv")).alias("path")
    )
    return files.next_month(paths)


#: Lines after which a partition goes on in another archive.
ARCHIVE_LINES = 500_000


def zip_partitions(lines: DataFrame, header: str | None = None) -> DataFrame:
    """Each partition of lines packed as archives of its own, each after `header`: test input for the reader."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = next(batches, None)
        while first is not None:
            buffer, n = io.BytesIO(), 0
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                with archive.open("flights.csv", "w") as member:
                    if header:
                        member.write((header + "\n").encode())
                    while first is not None and n < ARCHIVE_LINES:
                        member.write("".join(v + "\n" for v in first["value"]).encode())
                        n, first = n + len(first), next(batches, None)
            yield pd.DataFrame({"path": ["flights.zip"], "content": [buffer.getvalue()]})

    return lines.select("value").mapInPandas(pack, "path string, content binary")


@query("zip_lines", with_raw(f"""
SELECT op_unique_carrier AS carrier, count(*) AS n_lines, sum(length({_raw_line_sql(False)}))::BIGINT AS n_chars
FROM raw GROUP BY 1"""))
def zip_lines(spark, sf):
    lines = files.clean_lines(files.archive_lines(zip_partitions(raw_lines(spark, sf))))
    return lines.groupBy(F.split("value", ",")[1].alias("carrier")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars")
    )


PAYLOAD_SQL = "concat_ws(',', " + ", ".join(
    f"coalesce({n}::DECIMAL(20,{d})::VARCHAR, '')"
    if (d := {"dep_delay": 2, "taxi_out": 2, "taxi_in": 2, "arr_delay": 2, "distance": 2,
              "dep_airport_lat": 8, "dep_airport_lon": 8, "dep_airport_tzoffset": 1,
              "arr_airport_lat": 8, "arr_airport_lon": 8, "arr_airport_tzoffset": 1}.get(n))
    else f"coalesce({text(n)}, '')" if k == "timestamp" else f"coalesce({n}::VARCHAR, '')"
    for n, k in schemas.EVENT_ROW_COLUMNS
) + ")"


def payload_lines(spark, sf) -> DataFrame:
    """Stored event payloads; those of carrier UA are cut short and so malformed."""
    cut = F.when(
        F.col("op_unique_carrier") == "UA", F.concat(F.substring_index("line", ",", 30), F.lit(","))
    ).otherwise(F.col("line"))
    lines = event_lines(sample.corrected(spark, sf), "op_unique_carrier")
    return measured(lines.withColumnRenamed("value", "line").select(cut.alias("value")), "payload-lines")


@query("arity_check", with_events("""
SELECT event, count(*) AS n, sum(dep_delay) AS total_dep_delay, sum(arr_delay) AS total_arr_delay,
  max(epoch(notify_time)::BIGINT) AS latest
FROM events_log WHERE op_unique_carrier <> 'UA' GROUP BY event"""))
def arity_check(spark, sf):
    wanted = ["event", "dep_delay", "arr_delay", "notify_time"]
    return files.parse_events(payload_lines(spark, sf), columns=wanted).groupBy("event").agg(
        F.count(F.lit(1)).alias("n"), F.sum("dep_delay").alias("total_dep_delay"),
        F.sum("arr_delay").alias("total_arr_delay"), F.max(F.unix_timestamp("notify_time")).alias("latest"),
    )


@query("malformed_lines", with_events("""
SELECT count(*) AS n, 30::BIGINT AS most_fields FROM events_log WHERE op_unique_carrier = 'UA'"""))
def malformed_lines(spark, sf):
    bad = files.malformed_lines(payload_lines(spark, sf))
    return bad.agg(F.count(F.lit(1)).alias("n"), F.max("n_fields").cast("bigint").alias("most_fields"))


# --- airports and times -------------------------------------------------------

@query("airport_contains", with_raw("""
SELECT flight_key, origin, dest FROM raw WHERE flight_key || ',' || origin || ',' || dest LIKE '%MIA%'"""))
def airport_contains(spark, sf):
    flights = sample.flights(spark, sf, "flight_key", "origin", "dest")
    lines = flights.withColumn("value", csv_line("flight_key", "origin", "dest"))
    return lines.where(P.contains("MIA")).drop("value")


@query("airport_with_coordinates", f"""WITH {AIRPORTS}
SELECT airport_seq_id, latitude, longitude FROM airports WHERE latitude IS NOT NULL AND longitude IS NOT NULL""")
def airport_with_coordinates(spark, sf):
    return sample.airports(spark, sf).where(P.has_coordinates()).drop("code")


@query("airport_timezone_lookup", f"""WITH {AIRPORTS}
SELECT airport_seq_id, CASE WHEN code = 'MIA' THEN 'n/a' ELSE latitude::VARCHAR END AS latitude,
  CASE WHEN code = 'MIA' THEN 'TIMEZONE' ELSE tz END AS tz
FROM airports WHERE latitude IS NOT NULL AND longitude IS NOT NULL""")
def airport_timezone_lookup(spark, sf):
    text_airports = sample.airports(spark, sf).where(P.has_coordinates()).withColumns({
        "latitude": F.when(F.col("code") == "MIA", "n/a").otherwise(F.col("latitude").cast("string")),
        "longitude": F.col("longitude").cast("string"),
    })
    zoned = correction.with_timezone(text_airports, sample.airport_zones(spark, sf))
    return zoned.select("airport_seq_id", "latitude", "tz")


UTC_COLUMNS = ("crs_dep_time", "dep_time", "wheels_off", "wheels_on", "crs_arr_time", "arr_time")


@query("utc_times", with_corrected(f"""
SELECT op_carrier_fl_num, fl_date::VARCHAR AS fl_date, origin, dest, {', '.join(f'{text(c)} AS {c}' for c in UTC_COLUMNS)}
FROM corrected"""))
def utc_times(spark, sf):
    rows = sample.corrected(spark, sf).select(EVENT_KEY, F.col("fl_date").cast("string").alias("fl_date"),
                                              "origin", "dest", *UTC_COLUMNS)
    return _texts(rows, *UTC_COLUMNS)


@query("utc_offsets", with_corrected("""
SELECT origin, dest, dep_airport_tzoffset, arr_airport_tzoffset, dep_airport_lat, arr_airport_lon, count(*) AS n
FROM corrected GROUP BY ALL"""))
def utc_offsets(spark, sf):
    return sample.corrected(spark, sf).groupBy(
        "origin", "dest", "dep_airport_tzoffset", "arr_airport_tzoffset", "dep_airport_lat", "arr_airport_lon"
    ).agg(F.count(F.lit(1)).alias("n"))


@query("next_day_arrival", with_corrected(f"""
SELECT op_carrier_fl_num, {text('dep_time')} AS dep_time, {text('arr_time')} AS arr_time
FROM corrected WHERE arr_time::DATE > dep_time::DATE"""))
def next_day_arrival(spark, sf):
    rows = sample.corrected(spark, sf).where(F.to_date("arr_time") > F.to_date("dep_time"))
    return _texts(rows.select(EVENT_KEY, "dep_time", "arr_time"), "dep_time", "arr_time")


# --- event log ----------------------------------------------------------------

EVENT_VIEW = (EVENT_KEY, "origin", "dest", "event", "notify_time", "dep_delay", "taxi_out", "arr_delay", "diverted")
EVENT_VIEW_SQL = (
    f"op_carrier_fl_num, origin, dest, event, {text('notify_time')} AS notify_time, dep_delay, taxi_out, "
    "arr_delay, diverted"
)


def _view(events: DataFrame) -> DataFrame:
    return _texts(events.select(*EVENT_VIEW), "notify_time")


@query("flight_events", with_events(f"SELECT {EVENT_VIEW_SQL} FROM events_log"))
def flight_events(spark, sf):
    return _view(sample.event_log(spark, sf))


@query("event_payload", with_events(f"""
SELECT fl_date::VARCHAR AS fl_date, event, count(*) AS n, sum(length(event_data))::BIGINT AS n_chars,
  {checksum_sql('event_data')} AS hash
FROM (SELECT *, {PAYLOAD_SQL} AS event_data FROM events_log) GROUP BY 1, 2"""))
def event_payload_summary(spark, sf):
    from tarmac.operators.events import with_payload

    rows = with_payload(sample.event_log(spark, sf))
    return rows.groupBy(F.col("fl_date").cast("string").alias("fl_date"), "event").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("event_data")).alias("n_chars"),
        checksum("event_data").alias("hash"),
    )


@query("event_counts_by_type", with_events("SELECT event, count(*) AS n FROM events_log GROUP BY event"))
def event_counts_by_type(spark, sf):
    return sample.event_log(spark, sf).groupBy("event").agg(F.count(F.lit(1)).alias("n"))


@query("event_log_day", with_events(f"""
SELECT {EVENT_VIEW_SQL} FROM events_log
WHERE fl_date = DATE '2018-02-05' AND event IN ('departed', 'arrived') AND op_unique_carrier = 'AA'"""))
def event_log_day(spark, sf):
    return _view(sample.event_log(spark, sf).where(P.on_day("2018-02-05", carrier="AA")))


@query("event_log_cutoff", with_events(f"""
SELECT {EVENT_VIEW_SQL} FROM events_log WHERE fl_date <= DATE '2018-02-04'"""))
def event_log_cutoff(spark, sf):
    kinds = ("wheelsoff", "departed", "arrived")
    return _view(sample.event_log(spark, sf).where(P.up_to("2018-02-04", kinds)))


@query("event_time_slice", with_events(f"""
SELECT {EVENT_VIEW_SQL} FROM events_log
WHERE notify_time >= TIMESTAMP '2018-02-10 00:00:00' AND notify_time < TIMESTAMP '2018-02-12 00:00:00'"""))
def event_time_slice(spark, sf):
    start, end = F.to_timestamp(F.lit("2018-02-10 00:00:00")), F.to_timestamp(F.lit("2018-02-12 00:00:00"))
    return _view(sample.event_log(spark, sf).where(P.in_half_open("notify_time", start, end)))


@query("stored_event_log", with_events("""
SELECT dest, count(*) AS n, sum(dep_delay) AS total FROM events_log
WHERE fl_date <= DATE '2018-02-20' AND event = 'arrived' GROUP BY dest"""))
def stored_event_log(spark, sf):
    """Write the event log by day, then read back only the days and columns asked for."""
    from tarmac.session import scratch
    from tarmac.operators.events import flight_events
    from tarmac.sinks.tables import by_day, write_event_log

    path = scratch(spark, "event-log")
    flights = correction.correct_times(by_day(sample.flights(spark, sf)), sample.zoned_airports(spark, sf))
    write_event_log(flight_events(flights), path, arranged=True)
    log = tables.read_event_log(spark, path, P.up_to("2018-02-20", ("arrived",)), ["dest", "dep_delay"])
    return log.groupBy("dest").agg(F.count(F.lit(1)).alias("n"), F.sum("dep_delay").alias("total"))


@query("good_flights", with_events(f"""
SELECT {EVENT_VIEW_SQL} FROM events_log
WHERE (event = 'departed' AND cancelled = '0.00') OR (event = 'arrived' AND diverted = '0.00')"""))
def good_flights(spark, sf):
    return _view(sample.event_log(spark, sf).where(P.good_event()))


@query("good_flights_strict", with_events(f"""
SELECT {EVENT_VIEW_SQL} FROM events_log WHERE cancelled = '0.00' AND diverted = '0.00' AND event = 'arrived'"""))
def good_flights_strict(spark, sf):
    return _view(sample.event_log(spark, sf).where(P.good_arrival()))


SUCCESS_SQL = """((event = 'departed' AND cancelled = '0.00' AND dep_delay IS NOT NULL)
  OR (event = 'arrived' AND cancelled = '0.00' AND diverted = '0.00'
      AND dep_delay IS NOT NULL AND arr_delay IS NOT NULL))"""


@query("successful_flights", with_events(f"SELECT {EVENT_VIEW_SQL} FROM events_log WHERE {SUCCESS_SQL}"))
def successful_flights(spark, sf):
    return _view(sample.event_log(spark, sf).where(P.successful_event()))


@query("rejected_flights", with_events(
    f"SELECT {EVENT_VIEW_SQL} FROM events_log WHERE NOT coalesce({SUCCESS_SQL}, FALSE)"))
def rejected_flights(spark, sf):
    return _view(sample.event_log(spark, sf).where(P.rejected(P.successful_event())))


@query("event_states", with_events("""
SELECT (event = 'departed')::BIGINT AS departed, (event = 'arrived')::BIGINT AS arrived,
  (cancelled = '0.00')::BIGINT AS not_cancelled, (diverted = '0.00')::BIGINT AS not_diverted, count(*) AS n
FROM events_log GROUP BY ALL"""))
def event_states(spark, sf):
    states = {
        "departed": P.is_departed(), "arrived": P.is_arrived(),
        "not_cancelled": P.not_cancelled(), "not_diverted": P.not_diverted(),
    }
    return sample.event_log(spark, sf).groupBy(
        *[c.cast("bigint").alias(n) for n, c in states.items()]
    ).agg(F.count(F.lit(1)).alias("n"))


@query("departure_hours", with_events(f"""
SELECT origin, {DEP_HOUR} AS dep_hour, count(*) AS n FROM events_log GROUP BY 1, 2"""))
def departure_hours(spark, sf):
    return sample.event_log(spark, sf).groupBy("origin", departure_hour().alias("dep_hour")).agg(
        F.count(F.lit(1)).alias("n"))


# --- day selection and lookups ------------------------------------------------

DAY_COUNT_SQL = """
SELECT fl_date::VARCHAR AS fl_date, count(*) AS n, sum(arr_delay) AS total FROM raw
WHERE fl_date {op} (SELECT fl_date FROM days WHERE is_train_day) GROUP BY 1"""


def _by_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col("fl_date").cast("string").alias("fl_date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("arr_delay").alias("total"))


@query("train_semi", with_raw(DAY_COUNT_SQL.format(op="IN")))
def train_semi(spark, sf):
    return _by_day(lookups.select_days(
        sample.flights(spark, sf, "fl_date", "arr_delay"), sample.train_days(spark), True))


@query("test_anti", with_raw(DAY_COUNT_SQL.format(op="NOT IN")))
def test_anti(spark, sf):
    return _by_day(lookups.select_days(
        sample.flights(spark, sf, "fl_date", "arr_delay"), sample.train_days(spark), False))


@query("origin_hour_delay", with_averages(
    "SELECT origin, dep_hour, round(avg_dep_delay, 6) AS avg_dep_delay FROM dep_avg"))
def origin_hour_delay(spark, sf):
    good = sample.event_log(spark, sf).where(P.good_event())
    means = delays.origin_hour_delay(lookups.select_days(good, sample.train_days(spark)))
    return rounded(means, "avg_dep_delay")


@query("dest_arrival_delay", with_averages("""
SELECT dest, round(avg(arr_delay), 6) AS avg_arr_delay FROM good WHERE event = 'arrived' GROUP BY dest"""))
def dest_arrival_delay(spark, sf):
    good = sample.event_log(spark, sf).where(P.good_event())
    return rounded(delays.dest_arrival_delay(good), "avg_arr_delay")


def _averages(spark, sf) -> DataFrame:
    return training.departure_averages(sample.event_log(spark, sf), sample.train_days(spark))


WITH_DEP_SQL = with_averages(f"""
SELECT op_carrier_fl_num, origin, event, {text('notify_time')} AS notify_time,
  round(avg_dep_delay, 6) AS avg_dep_delay FROM featured""")


def _with_departure_average(spark, sf, strict: bool) -> DataFrame:
    good = sample.event_log(spark, sf).where(P.good_event())
    averages = _averages(spark, sf)
    if strict:
        # A complete lookup: hours never seen in training are added with mean 0.
        seen = good.select("origin", departure_hour().alias("dep_hour")).distinct()
        averages = seen.join(averages, ["origin", "dep_hour"], "left").fillna(0.0)
    out = lookups.with_departure_average(good, averages, strict)
    return _texts(rounded(out.select(EVENT_KEY, "origin", "event", "notify_time", "avg_dep_delay"),
                          "avg_dep_delay"), "notify_time")


@query("with_departure_average", WITH_DEP_SQL)
def with_departure_average(spark, sf):
    return _with_departure_average(spark, sf, strict=False)


@query("with_departure_average_strict", WITH_DEP_SQL)
def with_departure_average_strict(spark, sf):
    return _with_departure_average(spark, sf, strict=True)


# --- windows ------------------------------------------------------------------

def _good(spark, sf) -> DataFrame:
    return sample.event_log(spark, sf).where(P.good_event())


@query("sliding_arrival_delay", with_averages("""
SELECT dest, w::BIGINT AS window_start, w::BIGINT + 3600 AS window_end, round(avg(arr_delay), 6) AS mean, count(*) AS n
FROM (SELECT dest, arr_delay, unnest(range(slot - 3300, slot + 1, 300)) AS w FROM good
      WHERE event = 'arrived' AND arr_delay IS NOT NULL)
GROUP BY dest, w"""))
def sliding_arrival_delay(spark, sf):
    good = _good(spark, sf)
    known = F.when(P.is_arrived(), F.col("arr_delay"))
    return rounded(windows.sliding_means(windows.slot_totals(good, "dest", known), "dest"), "mean")


ARR_VIEW_SQL = (
    f"SELECT op_carrier_fl_num, dest, event, {text('notify_time')} AS notify_time, "
    "round(avg_arr_delay, 6) AS avg_arr_delay FROM "
)


def _arr_view(rows: DataFrame) -> DataFrame:
    view = rows.select(EVENT_KEY, "dest", "event", "notify_time", "avg_arr_delay")
    return _texts(rounded(view, "avg_arr_delay"), "notify_time")


@query("trailing_hour_arrival_delay", with_averages(ARR_VIEW_SQL + "featured"))
def trailing_hour_arrival_delay(spark, sf):
    return _arr_view(windows.with_arrival_average(_good(spark, sf)))


SLICE_SQL = """(
  SELECT g.*, coalesce(m, 0) AS avg_arr_delay
  FROM {source} g LEFT JOIN (
    SELECT dest, slot, avg(arr_delay) AS m FROM {source} s WHERE event = 'arrived' GROUP BY dest, slot) a
  ON a.dest = g.dest AND a.slot = g.slot)"""


@query("slice_arrival_delay", with_averages(ARR_VIEW_SQL + SLICE_SQL.format(source="good")))
def slice_arrival_delay(spark, sf):
    return _arr_view(windows.with_arrival_average(_good(spark, sf), mean_over="slice"))


@query("last_minute_arrival_delay", with_averages(ARR_VIEW_SQL + SLICE_SQL.format(
    source="(SELECT * FROM good WHERE slot + 300 - epoch(notify_time)::BIGINT <= 60)")))
def last_minute_arrival_delay(spark, sf):
    return _arr_view(windows.with_arrival_average(_good(spark, sf), mean_over="slice", slice_minutes=1))


@query("cogroup_flights", with_averages(f"""
SELECT origin, dest, event, {text('notify_time')} AS notify_time, round(avg_dep_delay, 6) AS avg_dep_delay,
  round(avg_arr_delay, 6) AS avg_arr_delay FROM featured"""))
def cogroup_flights(spark, sf):
    rows = training.with_averages(sample.event_log(spark, sf), _averages(spark, sf))
    view = rows.select("origin", "dest", "event", "notify_time", "avg_dep_delay", "avg_arr_delay")
    return _texts(rounded(view, "avg_dep_delay", "avg_arr_delay"), "notify_time")


@query("features_per_window", with_averages("""
SELECT dest, w::BIGINT AS window_start, count(*) AS n, sum(dep_delay) AS total_dep_delay,
  sum(coalesce(taxi_out, 0)) AS total_taxiout, sum(distance) AS total_distance,
  sum((arr_delay < 15)::BIGINT)::DOUBLE AS n_ontime, count(DISTINCT op_unique_carrier) AS n_carriers,
  count(DISTINCT origin) AS n_origins, min(dep_airport_lat) AS low_dep_lat, min(dep_airport_lon) AS low_dep_lon,
  max(arr_airport_lat) AS arr_lat, max(arr_airport_lon) AS arr_lon, min(round(m, 6)) AS low_arr_delay,
  max(round(m, 6)) AS avg_arr_delay
FROM (SELECT *, unnest(range(slot - 3300, slot + 1, 300)) AS w FROM good WHERE arr_delay IS NOT NULL) g
JOIN (SELECT dest, w, avg(arr_delay) AS m FROM (
    SELECT dest, arr_delay, unnest(range(slot - 3300, slot + 1, 300)) AS w FROM good WHERE event = 'arrived')
  GROUP BY dest, w) a USING (dest, w)
GROUP BY dest, w"""))
def features_per_window(spark, sf):
    """Carriers and airports are few, so their sets are collected instead of expanding every copy per distinct count."""
    events = sample.stored_events(spark, sf, *training.EVENT_COLUMNS)
    rows = training.features_per_window(events, training.departure_averages(events, sample.train_days(spark)))
    return rows.groupBy("dest", "window_start").agg(
        F.count(F.lit(1)).alias("n"), F.sum("dep_delay").alias("total_dep_delay"),
        F.sum("taxiout").alias("total_taxiout"), F.sum("distance").alias("total_distance"),
        F.sum("ontime").alias("n_ontime"), _named("carrier").alias("n_carriers"),
        _named("origin").alias("n_origins"), F.min("dep_lat").alias("low_dep_lat"),
        F.min("dep_lon").alias("low_dep_lon"), F.max("arr_lat").alias("arr_lat"), F.max("arr_lon").alias("arr_lon"),
        F.min(F.round("avg_arr_delay", 6)).alias("low_arr_delay"),
        F.max(F.round("avg_arr_delay", 6)).alias("avg_arr_delay"),
    )


def _named(column: str):
    return F.size(F.collect_set(column)).cast("bigint")


# --- training sets ------------------------------------------------------------

TRAINING = ", ".join(schemas.names(schemas.TRAINING_COLUMNS))


@query("training_rows", with_events("""
SELECT (arr_delay < 15)::INTEGER::DOUBLE AS ontime, dep_delay, taxi_out AS taxiout, distance,
  op_unique_carrier AS carrier, dep_airport_lat AS dep_lat, dep_airport_lon AS dep_lon,
  arr_airport_lat AS arr_lat, arr_airport_lon AS arr_lon, origin, dest
FROM events_log WHERE cancelled = '0.00' AND diverted = '0.00' AND event = 'arrived' AND arr_delay IS NOT NULL"""))
def training_rows(spark, sf):
    strict = sample.event_log(spark, sf).where(P.good_arrival())
    return training.training_rows(strict).drop("avg_dep_delay", "avg_arr_delay")


def _dataset(spark, sf, train: bool) -> DataFrame:
    events, days = sample.event_log(spark, sf), sample.train_days(spark)
    rows = training.dataset(events, days, training.departure_averages(events, days), train)
    return rounded(rows, "avg_dep_delay", "avg_arr_delay")


@query("training_set", with_averages(f"SELECT {TRAINING} FROM training JOIN days USING (fl_date) WHERE is_train_day"))
def training_set(spark, sf):
    return _dataset(spark, sf, train=True)


@query("test_set", with_averages(f"SELECT {TRAINING} FROM training JOIN days USING (fl_date) WHERE NOT is_train_day"))
def test_set(spark, sf):
    return _dataset(spark, sf, train=False)


@query("label_average", with_averages("SELECT round(avg(ontime), 6) AS ontime FROM training"))
def label_average(spark, sf):
    rows = training.training_rows(_good(spark, sf))
    return rows.agg(F.round(F.avg("ontime"), 6).alias("ontime"))


@query("input_features", with_averages("""
SELECT origin, dest, dep_delay AS f0, coalesce(taxi_out, 0) AS f1, distance AS f2,
  round(avg_dep_delay, 6) AS f3, round(avg_arr_delay, 6) AS f4 FROM featured"""))
def input_features(spark, sf):
    from tarmac.functions.features import input_features as features

    rows = training.with_averages(sample.event_log(spark, sf), _averages(spark, sf))
    out = rows.select("origin", "dest", features().alias("f"))
    return rounded(out.select("origin", "dest", *[F.col("f")[i].alias(f"f{i}") for i in range(5)]), "f3", "f4")


@query("flattened_fields", with_raw("SELECT count(*) AS n, 27::BIGINT AS n_fields FROM raw"))
def flattened_fields(spark, sf):
    """Split raw lines and count their fields once quotes and trailing commas are gone."""
    lines = files.clean_lines(raw_lines(spark, sf).select("value"))
    return lines.agg(
        F.count(F.lit(1)).alias("n"), F.max(field_count("value")).cast("bigint").alias("n_fields"))
