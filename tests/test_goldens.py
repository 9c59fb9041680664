"""Single operators on rows with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import ARR_DELAY, CANCELLED, DIVERTED, R1, R2, R3, R4, changed
from tarmac.functions import features, predicates as P, text, times
from tarmac.operators import bayes, correction, delays, events as ev, lookups, sampling, training, windows
from tarmac.sinks import cells, tables as table_sink
from tarmac.models import scoring
from tarmac.sources import files, tables


def parsed(spark, *rows):
    return files.parse_events(tables.lines(spark, list(rows)))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_arity(spark):
    lines = tables.lines(spark, [R1, R1.split(",", 1)[1], R4])
    assert files.parse_events(lines).count() == 1
    assert files.malformed_lines(lines).count() == 2


def test_payload_round_trip(spark):
    rows = parsed(spark, R1, R2, R3).select(text.event_payload().alias("v"))
    assert sorted(r["v"] for r in rows.collect()) == sorted([R1, R2, R3])


def test_trailing_empty_fields_do_not_count(spark):
    line = "a,b,,,"
    assert value(spark, text.field_count(F.lit(line))) == 2


@pytest.mark.parametrize("position", [CANCELLED, DIVERTED])
def test_cancelled_and_diverted(spark, position):
    rows = parsed(spark, R1, changed(R1, position, "1.00"))
    assert rows.where(P.flown()).count() == 1


def test_good_events(spark):
    assert parsed(spark, R2, R3).where(P.good_event()).count() == 2
    # The lenient form lets a cancelled arrival through, the strict one does not.
    odd = parsed(spark, changed(R1, CANCELLED, "1.00"))
    assert odd.where(P.good_event()).count() == 1
    assert odd.where(P.good_arrival()).count() == 0


def test_successful_and_rejected_split_the_input(spark):
    rows = parsed(spark, R1, R2, R3, changed(R1, ARR_DELAY, ""), changed(R3, 15, ""))
    ok = P.successful_event()
    assert rows.where(ok).count() == 3
    assert rows.where(P.rejected(ok)).count() == 2


def test_contains(spark):
    assert tables.lines(spark, [R1, R2]).where(P.contains("SEA")).count() == 1


def test_input_features(spark):
    rows = parsed(spark, R1).withColumns({
        "avg_dep_delay": F.lit(None).cast("double"), "avg_arr_delay": F.lit(None).cast("double")})
    assert one(rows.select(features.input_features().alias("f")))["f"] == [6.0, 14.0, 1024.0, None, None]
    departed = parsed(spark, R3).withColumns({"avg_dep_delay": F.lit(1.0), "avg_arr_delay": F.lit(2.0)})
    assert one(departed.select(features.input_features().alias("f")))["f"] == [7.0, 0.0, 328.0, 1.0, 2.0]


def test_training_row(spark):
    assert tuple(one(training.training_rows(parsed(spark, R1)))) == (
        1.0, 6.0, 14.0, 1024.0, None, None, "WN", 47.45, -122.31166667, 39.86166667, -104.67305556, "SEA", "DEN")
    late = one(training.training_rows(parsed(spark, changed(R1, ARR_DELAY, "15.00"))))
    assert late["ontime"] == 0.0
    assert training.training_rows(parsed(spark, R3)).count() == 0


def test_departure_hour_and_event_time(spark):
    row = one(parsed(spark, R1).select(times.departure_hour().alias("h"), "notify_time"))
    assert row["h"] == "20"
    assert row["notify_time"] == dt.datetime(2019, 5, 15, 5, 38)
    assert value(spark, times.event_time(F.lit("2019-05-15 05:38:00"))) == dt.datetime(2019, 5, 15, 5, 38)


def test_half_hour_offsets_count_in_whole_hours(spark):
    row = parsed(spark, changed(R1, 29, "-23400.0"))
    assert one(row.select(times.departure_hour().alias("h")))["h"] == "21"


def test_origin_hour_average_and_lookup(spark):
    rows = parsed(spark, R2)
    averages = delays.origin_hour_delay(rows)
    assert tuple(one(averages)) == ("PHX", "06", 29.0)
    assert one(delays.delay_lines(averages))["value"] == "PHX:06,29.0"
    assert one(lookups.with_departure_average(rows, averages))["avg_dep_delay"] == 29.0
    assert one(lookups.with_departure_average(parsed(spark, R1), averages))["avg_dep_delay"] == 0.0
    with pytest.raises(Exception, match="no departure average for SEA:20"):
        lookups.with_departure_average(parsed(spark, R1), averages, strict=True).collect()


def test_group_average(spark):
    rows = parsed(spark, R2)
    means = spark.createDataFrame([("BOI", 6.0)], "dest string, avg_arr_delay double")
    assert one(lookups.with_group_average(rows, means, ["dest"], "avg_arr_delay"))["avg_arr_delay"] == 6.0
    assert one(windows.with_arrival_average(rows))["avg_arr_delay"] == 6.0


def test_day_selection(spark):
    days = spark.createDataFrame([(dt.date(2019, 5, 14), True)], "fl_date date, is_train_day boolean")
    rows = parsed(spark, R1, changed(R1, 0, "2019-05-15"))
    assert [r["fl_date"].day for r in lookups.select_days(rows, days, True).collect()] == [14]
    assert [r["fl_date"].day for r in lookups.select_days(rows, days, False).collect()] == [15]
    with pytest.raises(ValueError):
        lookups.select_days(rows, None)


@pytest.mark.parametrize("day, hhmm, zone, utc, offset", [
    ("2018-01-02", "2400", "America/Chicago", dt.datetime(2018, 1, 3, 6), -21600.0),
    ("2018-03-11", "0900", "America/New_York", dt.datetime(2018, 3, 11, 14), -18000.0),
    ("2018-07-04", "0056", "America/New_York", dt.datetime(2018, 7, 4, 4, 56), -14400.0),
    ("2018-07-04", "", "America/New_York", None, 0.0),
    ("2018-07-04", None, "America/New_York", None, 0.0),
])
def test_utc(spark, day, hhmm, zone, utc, offset):
    row = spark.createDataFrame([(day, hhmm, zone)], "d string, t string, z string").select(
        F.to_date("d").alias("d"), "t", "z"
    ).withColumn("m", times.midnight_utc("d", "z")).select(
        times.utc_time("m", "t").alias("utc"), times.utc_offset("d", "m", "t").alias("offset")).first()
    assert (row["utc"], row["offset"]) == (utc, offset)


def raw_row(spark, **values):
    from tarmac import schemas

    base = {f.name: None for f in schemas.RAW_FLIGHT}
    base |= {
        "fl_date": dt.date(2018, 1, 2), "origin_airport_seq_id": "1", "dest_airport_seq_id": "2",
        "crs_dep_time": "2300", "dep_time": "2310", "wheels_off": "2330", "wheels_on": "0100",
        "crs_arr_time": "0110", "arr_time": "0120", "cancelled": "0.00", "diverted": "0.00",
    } | values
    return spark.createDataFrame([tuple(base[f.name] for f in schemas.RAW_FLIGHT)], schemas.RAW_FLIGHT)


def test_correction_moves_arrivals_to_the_next_day_and_uses_the_fallback(spark):
    airports = spark.createDataFrame(
        [("1", "40.0", "-75.0", "America/New_York")], "airport_seq_id string, latitude string, longitude string, tz string")
    row = one(correction.correct_times(raw_row(spark), airports))
    assert row["dep_time"] == dt.datetime(2018, 1, 3, 4, 10)
    # Destination unknown: Chicago.  01:20 local on the flight date is before departure.
    assert row["arr_time"] == dt.datetime(2018, 1, 3, 7, 20)
    assert (row["arr_airport_lat"], row["arr_airport_lon"]) == (37.52, -92.17)
    assert (row["dep_airport_tzoffset"], row["arr_airport_tzoffset"]) == (-18000.0, -21600.0)


def test_offsets_follow_the_last_time_of_each_side(spark):
    airports = spark.createDataFrame([], "airport_seq_id string, latitude string, longitude string, tz string")
    row = one(correction.correct_times(raw_row(spark, wheels_off=None, arr_time=None), airports))
    assert (row["dep_airport_tzoffset"], row["arr_airport_tzoffset"]) == (0.0, 0.0)


def test_timezone_lookup(spark):
    airports = spark.createDataFrame(
        [("1", "40", "-75"), ("2", "50", "1"), ("3", "x", "1")], "airport_seq_id string, latitude string, longitude string")
    zones = spark.createDataFrame([("1", "America/New_York")], "airport_seq_id string, tz string")
    got = {r["airport_seq_id"]: r["tz"] for r in correction.with_timezone(airports, zones).collect()}
    assert got == {"1": "America/New_York", "2": "UTC", "3": "TIMEZONE"}


def test_events_of_a_flight(spark):
    airports = spark.createDataFrame([], "airport_seq_id string, latitude string, longitude string, tz string")
    rows = {r["event"]: r for r in ev.flight_events(
        correction.correct_times(raw_row(spark, taxi_out=20.0, arr_delay=5.0), airports)).collect()}
    assert set(rows) == {"departed", "arrived"}
    assert rows["departed"]["taxi_out"] is None and rows["departed"]["diverted"] is None
    assert rows["departed"]["notify_time"] == rows["departed"]["dep_time"]
    assert rows["arrived"]["taxi_out"] == 20.0
    assert rows["arrived"]["notify_time"] == rows["arrived"]["arr_time"]
    gone = ev.flight_events(correction.correct_times(raw_row(spark, dep_time=None, arr_time=None), airports))
    assert gone.count() == 0


def test_null_bins_and_edges(spark):
    rows = spark.createDataFrame(
        [(None, None, None), (214.0, -8.0, 15.0), (213.0, -9.0, 14.0), (5000.0, 99.0, 99.0)],
        "distance double, dep_delay double, arr_delay double")
    got = [tuple(r)[3:] for r in bayes.with_bins(rows).collect()]
    assert got == [(None, None, None), (1, 1, 0.0), (0, 0, 1.0), (9, 9, 0.0)]


DECISIONS = [
    # event, cancelled, diverted, arr_delay, probability, decision
    ("arrived", "0.00", "0.00", 14.0, 0.2, 1.0),
    ("arrived", "0.00", "0.00", 15.0, 0.9, 0.0),
    ("departed", "0.00", None, None, 0.6, 0.6),
    ("arrived", "1.00", "0.00", 3.0, 0.4, 0.4),
    ("arrived", "0.00", "1.00", 3.0, 0.4, 0.4),
    ("arrived", "0.00", "0.00", 3.0, None, -5.0),
    ("departed", "0.00", None, None, None, -5.0),
]


def test_decision_table(spark):
    rows = spark.createDataFrame(
        [d[:5] for d in DECISIONS], "event string, cancelled string, diverted string, arr_delay double, probability double")
    got = [r["v"] for r in rows.select(features.ontime_decision().alias("v")).collect()]
    assert got == [d[5] for d in DECISIONS]


def test_prediction_line_and_cells(spark):
    decided = parsed(spark, R1, R3).withColumn("ontime", F.when(P.is_arrived(), 1.0).otherwise(-5.0))
    lines = sorted(r["value"] for r in table_sink.prediction_lines(decided).collect())
    assert lines == sorted([R1 + ",1.00", R3 + ","])
    made = cells.prediction_cells(decided).collect()
    left = dt.datetime(2019, 5, 15, 3, 10, tzinfo=dt.timezone.utc)
    key = f"SEA#DEN#WN#{2**63 - 1 - int(left.timestamp()) * 1000}"
    arrived = {c["qualifier"]: c["value"] for c in made if c["row_key"] == key}
    assert arrived["ONTIME"] == "1.00" and arrived["DEP_DELAY"] == "6.00"
    assert "CANCELLATION_CODE" not in arrived
    departed = {c["qualifier"] for c in made if c["row_key"] != key}
    assert "ONTIME" not in departed and "ARR_TIME" not in departed
    typed = {r["event"]: r for r in table_sink.prediction_rows(decided).collect()}
    assert typed["arrived"]["origin_airport_seq_id"] == 1474703
    assert typed["departed"]["arr_delay"] is None


def test_ties_to_even(spark):
    rows = spark.createDataFrame([(0.125,), (0.375,), (1.0,)], "v double").select(table_sink.two_decimals("v").alias("v"))
    assert [r["v"] for r in rows.collect()] == ["0.12", "0.38", "1.00"]


def test_payload_json(spark):
    import json

    rows = parsed(spark, R1).withColumns({"avg_dep_delay": F.lit(1.5), "avg_arr_delay": F.lit(2.5)})
    got = json.loads(one(rows.select(scoring.payload().alias("j")))["j"])
    assert got == [{
        "dep_delay": 6.0, "taxiout": 0.0, "distance": 1024.0, "avg_dep_delay": 1.5, "avg_arr_delay": 2.5,
        "dep_lat": 47.45, "dep_lon": -122.31166667, "arr_lat": 39.86166667, "arr_lon": -104.67305556,
        "carrier": "WN", "origin": "SEA", "dest": "DEN"}]


def test_clean_line(spark):
    assert value(spark, text.clean_line(F.lit('"a","b",,1.00,, \r'))) == "a,b,,1.00"


def test_rfc3339_and_stamp(spark):
    moment = F.to_timestamp(F.lit("2018-03-04 05:06:07"))
    assert value(spark, times.rfc3339(moment)) == "2018-03-04T05:06:07Z"
    assert value(spark, text.stamped(F.lit("x"), moment)) == "2018-03-04 05:06:07 x"


def test_hash_sample_is_stable_and_near_its_fraction(spark):
    ids = spark.range(20000)
    a = sampling.by_key(ids, 0.1, "id").count()
    assert a == sampling.by_key(ids.repartition(7), 0.1, "id").count()
    assert 1700 < a < 2300


def test_row_slice(spark):
    got = sampling.row_slice(spark.range(100).repartition(5), ["id"], 10, 13)
    assert [(r["id"], r["row_no"]) for r in got.orderBy("id").collect()] == [(10, 10), (11, 11), (12, 12)]
