"""Composite jobs from files to files, each read back and compared with SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tarmac import schemas
from tarmac.catalog.checksql import AIRPORTS, DEP_HOUR, EVENTS, with_averages, with_events, with_raw
from tarmac.catalog.flightlog import PAYLOAD_SQL
from tarmac.catalog.registry import checksum, checksum_sql, query, rounded
from tarmac.functions.text import csv_line
from tarmac.operators import training
from tarmac.operators.events import event_lines
from tarmac.plans import datasets, ingest
from tarmac.session import measured, scratch
from tarmac.sinks import tables as table_sink
from tarmac.sources import files, sample


def _lines(spark, sf):
    return measured(event_lines(sample.corrected(spark, sf)), "event-lines")


def n_rows():
    return F.count(F.lit(1)).alias("n")


@query("airport_master_job", f"""WITH {AIRPORTS}
SELECT airport_seq_id, latitude, longitude, tz FROM airports WHERE latitude IS NOT NULL AND longitude IS NOT NULL""")
def airport_master_job(spark, sf):
    """A gzip master file with commas in quoted names, to ids with coordinates and zones."""
    master, out = scratch(spark, "airport-master"), scratch(spark, "airports")
    known = sample.airports(spark, sf)
    at = {i: name for name, i in schemas.AIRPORT_FILE_POSITIONS.items()}
    columns = [F.col(at[i]).alias(at[i]) if i in at else F.concat("code", F.lit(f", field {i}")).alias(f"field_{i}")
               for i in range(max(at) + 2)]
    known.select(*columns).write.option("header", True).option("compression", "gzip").csv(master)
    ingest.store_airports(spark, master, out, sample.airport_zones(spark, sf))
    return spark.read.schema("airport_seq_id string, latitude double, longitude double, tz string").csv(out)


@query("header_guard", with_raw("""
SELECT op_carrier, count(*) AS n, min(fl_date)::VARCHAR AS first, sum(distance) AS distance FROM raw GROUP BY op_carrier"""))
def header_guard(spark, sf):
    """Several files per carrier, each with the header line at its start and once more at its end."""
    path = scratch(spark, "two-headers")
    names = schemas.names(schemas.RAW_COLUMNS)
    rows = sample.flights(spark, sf).select(
        F.concat_ws("-", "op_carrier", F.pmod(F.xxhash64("op_carrier_fl_num", "fl_date"), F.lit(16))).alias("part"), F.lit(1).alias("place"), csv_line(*names).alias("value"))
    header = F.lit(",".join(names).upper())
    heads = rows.select("part").distinct().select(
        "part", F.explode(F.array(F.lit(0), F.lit(2))).alias("place"), header.alias("value"))
    rows.unionByName(heads).repartition("part").sortWithinPartitions("part", "place").select("part", "value").write.partitionBy("part").text(path)
    return files.read_raw_flights(spark, f"{path}/*/*").groupBy("op_carrier").agg(
        n_rows(), F.min("fl_date").cast("string").alias("first"), F.sum("distance").alias("distance"))


@query("relational_table", with_raw("""
SELECT origin, count(*) AS n, sum(dep_time::BIGINT)::BIGINT AS dep_time, sum(cancelled::DOUBLE) AS cancelled,
  max(distance::VARCHAR) AS distance FROM raw GROUP BY origin"""))
def relational_table(spark, sf):
    """Raw flights loaded into the table that the drop-and-create statement makes."""
    database = f"relational_{uuid.uuid4().hex[:8]}"
    table_sink.create_relational_table(spark, database)
    raw = sample.flights(spark, sf).select(*schemas.names(schemas.RAW_COLUMNS))
    files.load_relational(raw).write.insertInto(f"{database}.flights")
    return spark.table(f"{database}.flights").groupBy("origin").agg(
        n_rows(), F.sum("dep_time").alias("dep_time"), F.sum(F.col("cancelled").cast("double")).alias("cancelled"),
        F.max("distance").alias("distance"))


@query("airport_filter_job", with_events(f"""
SELECT split_part(line, ',', 1) AS fl_date, count(*) AS n, {checksum_sql('line')} AS hash
FROM (SELECT {PAYLOAD_SQL} AS line FROM events_log) WHERE line LIKE '%MIA%' GROUP BY 1"""))
def airport_filter_job(spark, sf):
    out = scratch(spark, "airport-lines")
    ingest.filter_airport(_lines(spark, sf), "MIA", out)
    return spark.read.text(out).groupBy(F.split("value", ",")[0].alias("fl_date")).agg(n_rows(), checksum("value").alias("hash"))


@query("strict_training_job", with_events("""
SELECT origin, dest, count(*) AS n, sum((arr_delay < 15)::INTEGER)::DOUBLE AS ontime, sum(dep_delay) AS dep_delay,
  sum(taxi_out) AS taxiout, sum(distance) AS distance
FROM events_log WHERE event = 'arrived' AND cancelled = '0.00' AND diverted = '0.00' AND arr_delay IS NOT NULL GROUP BY 1, 2"""))
def strict_training_job(spark, sf):
    out = scratch(spark, "strict-training")
    datasets.strict_training_csv(_lines(spark, sf), out)
    return files.read_training_rows(spark, out).groupBy("origin", "dest").agg(
        n_rows(), *[F.sum(c).alias(c) for c in ("ontime", "dep_delay", "taxiout", "distance")])


HOURLY_SQL = f"""
hourly AS (
  SELECT origin, {DEP_HOUR} AS dep_hour, round(avg(dep_delay + taxi_out), 6) AS avg_dep_delay FROM events_log
  WHERE event = 'arrived' AND diverted = '0.00' {{where}} GROUP BY ALL)"""


@query("hourly_averages_job", f"WITH {EVENTS},{HOURLY_SQL.format(where='')} SELECT * FROM hourly")
def hourly_averages_job(spark, sf):
    out = scratch(spark, "hourly")
    datasets.hourly_averages(_lines(spark, sf), out)
    return rounded(files.read_delay_lookup(spark, out), "avg_dep_delay")


@query("train_day_job", with_events("""
SELECT fl_date::VARCHAR AS fl_date, event, count(*) AS n, sum(dep_delay) AS dep_delay
FROM events_log JOIN days USING (fl_date) WHERE is_train_day GROUP BY 1, 2"""))
def train_day_job(spark, sf):
    events = datasets.training_day_events(_lines(spark, sf), sample.train_days(spark))
    return events.groupBy(F.col("fl_date").cast("string").alias("fl_date"), "event").agg(n_rows(), F.sum("dep_delay").alias("dep_delay"))


@query("one_day_job", f"""
WITH {EVENTS},{HOURLY_SQL.format(where="AND fl_date = DATE '2018-02-05'")}
SELECT 'train' AS part, origin AS key, count(*) AS n, sum(dep_delay) AS total FROM events_log
WHERE fl_date = DATE '2018-02-05' AND event = 'arrived' AND diverted = '0.00' AND arr_delay IS NOT NULL GROUP BY origin
UNION ALL SELECT 'delays', origin || ':' || dep_hour, 1, avg_dep_delay FROM hourly""")
def one_day_job(spark, sf):
    """Training rows and hourly averages of one day of the stored log."""
    out = scratch(spark, "one-day")
    datasets.day_to_training(sample.stored_events(spark, sf, *training.EVENT_COLUMNS), "2018-02-05", out)
    train = files.read_training_rows(spark, f"{out}/train").groupBy(F.lit("train").alias("part"), F.col("origin").alias("key")).agg(
        n_rows(), F.sum("dep_delay").alias("total"))
    delays = files.read_delay_lookup(spark, f"{out}/delays").select(
        F.lit("delays").alias("part"), F.concat_ws(":", "origin", "dep_hour").alias("key"), F.lit(1).cast("bigint").alias("n"),
        F.round("avg_dep_delay", 6).alias("total"))
    return train.unionByName(delays)


@query("departure_features_job", with_averages("""
SELECT g.origin, g.dest, count(*) AS n, sum(g.dep_delay) AS dep_delay, round(sum(coalesce(h.mean, 0)), 4) AS avg_dep_delay
FROM good g LEFT JOIN (SELECT origin, dep_hour, avg(dep_delay + taxi_out) AS mean FROM good WHERE event = 'arrived' GROUP BY ALL) h
  ON h.origin = g.origin AND h.dep_hour = g.dep_hour
WHERE g.arr_delay IS NOT NULL GROUP BY 1, 2"""))
def departure_features_job(spark, sf):
    rows = datasets.departure_features(_lines(spark, sf))
    return rounded(rows.groupBy("origin", "dest").agg(
        n_rows(), F.sum("dep_delay").alias("dep_delay"), F.sum("avg_dep_delay").alias("avg_dep_delay")), "avg_dep_delay", digits=4)
