"""Queries that write a result in some form and read it back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tarmac import schemas
from tarmac.catalog.checksql import text, with_averages, with_corrected, with_events, with_raw
from tarmac.catalog.registry import query, rounded
from tarmac.functions.text import csv_line, payload_fields
from tarmac.functions.times import time_text
from tarmac.operators import delays, explore, training
from tarmac.operators.events import with_payload
from tarmac.plans import datasets, ingest, studies
from tarmac.session import delete, scratch, tidy
from tarmac.sinks import files as file_sink, tables as table_sink
from tarmac.sources import files, sample, tables


def n_rows():
    return F.count(F.lit(1)).alias("n")


@query("csv_roundtrip", with_raw("""
SELECT origin, count(*) AS n, count(dep_time) AS n_dep, sum(dep_delay) AS dep_delay, min(crs_dep_time) AS first,
  sum(distance) AS distance FROM raw GROUP BY origin"""))
def csv_roundtrip(spark, sf):
    path = scratch(spark, "raw-csv")
    file_sink.write_csv(sample.flights(spark, sf), path, header=True)
    return files.read_raw_flights(spark, path).groupBy("origin").agg(
        n_rows(), F.count("dep_time").alias("n_dep"), F.sum("dep_delay").alias("dep_delay"),
        F.min("crs_dep_time").alias("first"), F.sum("distance").alias("distance"),
    )


@query("corrected_csv_roundtrip", with_corrected(f"""
SELECT dest, count(*) AS n, {text('max(arr_time)')} AS latest, sum(arr_delay) AS arr_delay,
  sum(dep_airport_tzoffset) AS offsets, 0::BIGINT AS n_events
FROM corrected GROUP BY dest"""))
def corrected_csv_roundtrip(spark, sf):
    """Headerless gzip files of 33 columns read under the 35-column schema."""
    path = scratch(spark, "corrected-csv")
    fields = payload_fields(schemas.CORRECTED_COLUMNS)
    file_sink.write_lines(sample.corrected(spark, sf).select(csv_line(*fields).alias("value")), path, packed=True)
    tidy(spark)
    return files.read_corrected_flights(spark, path).groupBy("dest").agg(
        n_rows(), time_text(F.max("arr_time")).alias("latest"), F.sum("arr_delay").alias("arr_delay"),
        F.sum("dep_airport_tzoffset").alias("offsets"), F.count("event").alias("n_events"),
    )


@query("schema_sidecar", with_raw("""
SELECT dist::BIGINT AS dist, delay::BIGINT AS delay, round(avg(ontime), 6) AS ontime FROM (
  SELECT CASE WHEN distance IS NOT NULL THEN
      len(list_filter([214, 316, 394, 493, 596, 731, 868, 1020, 1269], lambda e: e <= distance)) END AS dist,
    CASE WHEN dep_delay IS NOT NULL THEN
      len(list_filter([-8, -6, -4, -3, -2, 0, 2, 6, 13], lambda e: e <= dep_delay)) END AS delay,
    (arr_delay < 15)::INTEGER::DOUBLE AS ontime FROM raw) GROUP BY 1, 2"""))
def schema_sidecar(spark, sf):
    path = scratch(spark, "bayes")
    studies.store_bayes_table(sample.flights(spark, sf, "distance", "dep_delay", "arr_delay"), path)
    back = file_sink.read_csv_with_schema(spark, path)
    return rounded(back, "ontime").select(
        F.col("dist").cast("bigint").alias("dist"), F.col("delay").cast("bigint").alias("delay"), "ontime")


WAREHOUSE_NAMES = {"date": "DATE", "string": "STRING", "bigint": "INTEGER", "double": "FLOAT", "timestamp": "TIMESTAMP"}


@query("external_csv_average", with_events("""
SELECT origin, round(avg(dep_delay), 6) AS dep_delay, round(avg(arr_delay), 6) AS arr_delay
FROM events_log GROUP BY origin"""))
def external_csv_average(spark, sf):
    """Event log as CSV behind a table declared by a JSON field list."""
    path = scratch(spark, "external-csv")
    log = with_payload(sample.event_log(spark, sf)).drop("event_data")
    file_sink.write_csv(log, path, packed=True)
    kinds = dict(schemas.EVENT_LOG_COLUMNS)
    fields = [{"mode": "NULLABLE", "name": c.upper(), "type": WAREHOUSE_NAMES[kinds[c]]} for c in log.columns]
    external = files.create_external_table(spark, "external_flights", path, json.dumps(fields))
    return rounded(delays.origin_average_delay(external), "dep_delay", "arr_delay")


@query("saved_delay_table", with_raw("""
SELECT dep_delay, round(arrival_delay, 6) AS arrival_delay, numflights FROM (
  SELECT dep_delay, avg(arr_delay) AS arrival_delay, count(arr_delay) AS numflights FROM raw GROUP BY dep_delay)
WHERE numflights > 370"""))
def saved_delay_table(spark, sf):
    table = explore.frequent_delays(sample.flights(spark, sf, "dep_delay", "arr_delay"))
    table_sink.create_database(spark, "tempdataset")
    table_sink.save_table(table, "tempdataset.delays", scratch(spark, "delays-table"))
    return rounded(spark.table("tempdataset.delays"), "arrival_delay").select("dep_delay", "arrival_delay", "numflights")


@query("relational_load", with_raw("""
SELECT origin, count(*) AS n, sum(dep_time::BIGINT)::BIGINT AS dep_time, sum(cancelled::DOUBLE) AS cancelled,
  max(distance::VARCHAR) AS distance FROM raw GROUP BY origin"""))
def relational_load(spark, sf):
    rows = files.load_relational(sample.flights(spark, sf))
    return rows.groupBy("origin").agg(
        n_rows(), F.sum("dep_time").alias("dep_time"), F.sum(F.col("cancelled").cast("double")).alias("cancelled"),
        F.max("distance").alias("distance"),
    )


@query("delay_lookup_file", with_averages("SELECT origin, dep_hour, round(avg_dep_delay, 6) AS avg_dep_delay FROM dep_avg"))
def delay_lookup_file(spark, sf):
    """Averages written as `ORIGIN:HH,mean` to one file and read as a lookup."""
    path = scratch(spark, "delays-csv")
    averages = training.departure_averages(sample.event_log(spark, sf), sample.train_days(spark))
    datasets.write_averages(averages, path)
    return rounded(files.read_delay_lookup(spark, path), "avg_dep_delay")


@query("train_days_file", with_raw("SELECT fl_date::VARCHAR AS fl_date FROM raw JOIN days USING (fl_date) WHERE is_train_day GROUP BY 1"))
def train_days_file(spark, sf):
    """Day list written as text, read back, and joined with the flights."""
    path = scratch(spark, "days-csv")
    days = sample.train_days(spark).select(
        "fl_date", F.initcap(F.col("is_train_day").cast("string")).alias("is_train_day"))
    file_sink.write_csv(days, path, header=True)
    back = files.read_train_days(spark, path, only_train=True)
    rows = sample.flights(spark, sf, "fl_date").join(back, "fl_date", "left_semi")
    return rows.select(F.col("fl_date").cast("string").alias("fl_date")).distinct()


@query("training_csv", with_averages("""
SELECT is_train_day::BIGINT AS is_train, origin, count(*) AS n, sum(ontime) AS ontime, sum(dep_delay) AS dep_delay,
  sum((avg_arr_delay * 1000000)::BIGINT)::BIGINT AS avg_arr_delay
FROM training JOIN days USING (fl_date) GROUP BY 1, 2"""))
def training_csv(spark, sf):
    """The whole data-set job: event log to training, test and averages files, read back."""
    out = scratch(spark, "datasets")
    datasets.train_and_test(sample.event_log(spark, sf), sample.train_days(spark), out)
    parts = [
        files.read_training_rows(spark, f"{out}/{name}").withColumn("is_train", F.lit(flag).cast("bigint"))
        for name, flag in (("train", 1), ("test", 0))
    ]
    micro = F.round(F.round("avg_arr_delay", 6) * 1000000).cast("bigint")
    return parts[0].unionByName(parts[1]).groupBy("is_train", "origin").agg(
        n_rows(), F.sum("ontime").alias("ontime"), F.sum("dep_delay").alias("dep_delay"),
        F.sum(micro).alias("avg_arr_delay"),
    )


@query("training_epochs", with_averages("""
SELECT e AS epoch, origin, count(*) AS n, sum(ontime) AS ontime, sum(dep_delay) AS dep_delay
FROM training JOIN days USING (fl_date), range(3) AS r(e) WHERE is_train_day GROUP BY 1, 2"""))
def training_epochs(spark, sf):
    """The stored training rows three times over: every epoch holds every row once."""
    out = scratch(spark, "epochs")
    datasets.train_and_test(sample.stored_events(spark, sf, *training.EVENT_COLUMNS), sample.train_days(spark), out)
    rows = files.epochs(files.read_training_rows(spark, f"{out}/train"), 3)
    return rows.groupBy(F.col("epoch").cast("bigint").alias("epoch"), "origin").agg(
        n_rows(), F.sum("ontime").alias("ontime"), F.sum("dep_delay").alias("dep_delay"))


@query("corrected_and_logged", with_events("""
SELECT event, count(*) AS n, sum(dep_delay) AS dep_delay, count(DISTINCT fl_date) AS n_days FROM events_log GROUP BY event"""))
def corrected_and_logged(spark, sf):
    """Raw flights through correction to the stored event log."""
    out = scratch(spark, "logged")
    ingest.correct_and_log(
        sample.flights(spark, sf), sample.zoned_airports(spark, sf), f"{out}/corrected", f"{out}/log")
    log = tables.read_event_log(spark, f"{out}/log")
    return log.groupBy("event").agg(
        n_rows(), F.sum("dep_delay").alias("dep_delay"), F.count_distinct("fl_date").alias("n_days"))


@query("ingested_month", with_raw("""
SELECT op_unique_carrier, count(*) AS n, sum(dep_delay) AS dep_delay, sum(distance) AS distance FROM raw GROUP BY 1"""))
def ingested_month(spark, sf):
    """Quoted lines cleaned and stored as the month file, then read as raw flights."""
    from tarmac.catalog.flightlog import raw_lines

    path = scratch(spark, "month")
    cleaned = files.clean_lines(raw_lines(spark, sf).select("value"))
    file_sink.write_lines(cleaned, f"{path}/201802.csv")
    back = ingest.read_ingested(spark, path)
    return back.groupBy("op_unique_carrier").agg(
        n_rows(), F.sum("dep_delay").alias("dep_delay"), F.sum("distance").alias("distance"))


@query("monthly_ingest", with_raw("""
SELECT strftime(fl_date, '%Y%m') AS month, op_unique_carrier, count(*) AS n, sum(dep_delay) AS dep_delay, sum(distance) AS distance
FROM raw GROUP BY 1, 2"""))
def monthly_ingest(spark, sf):
    """Zip files of every month, opened, cleaned, verified and published one month after another."""
    from tarmac.catalog.flightlog import raw_lines, zip_partitions

    path = scratch(spark, "monthly")
    day = F.to_date(F.substring_index("value", ",", 1))
    # Made once and stored by month: a month's archives are packed from its folder alone.
    table_sink.write_folders(raw_lines(spark, sf).withColumn("month", F.date_format(day, "yyyyMM")), f"{path}/lines", "month")
    lines = spark.read.schema("op_unique_carrier string, value string, month string").parquet(f"{path}/lines")
    months = [r[0] for r in lines.select("month").distinct().collect()]
    for month in months:
        packed = zip_partitions(lines.where(F.col("month") == month).drop("month"), schemas.RAW_HEADER)
        # Bytes as they are, one archive a file.
        packed.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(f"{path}/delivered/{month}")
    delete(spark, f"{path}/lines")
    tidy(spark)
    ingest.ingest_months(spark, f"{path}/delivered", f"{path}/raw", min(months), max(months))
    stored = F.regexp_extract(F.col("_metadata.file_path"), r"/raw/(\d{6})\.csv/", 1).alias("month")
    return ingest.read_ingested(spark, f"{path}/raw").groupBy(stored, "op_unique_carrier").agg(
        n_rows(), F.sum("dep_delay").alias("dep_delay"), F.sum("distance").alias("distance"))


@query("array_map_struct_demo", with_raw("""
SELECT origin AS word, 'checked' AS added, 2::BIGINT AS n_fields, origin AS name, origin AS key1, origin AS key3,
  count(*) AS n FROM raw GROUP BY origin"""))
def array_map_struct_demo(spark, sf):
    """Append a constant as an array, build an object and project a member, build a map."""
    word = F.col("origin")
    made = sample.flights(spark, sf, "origin").select(
        F.array(word, F.lit("checked")).alias("a"),
        F.struct(F.lit("jet").alias("kind"), F.lit("B6").alias("carrier"), word.alias("name")).alias("s"),
        F.create_map(*[c for k in ("key1", "key2", "key3") for c in (F.lit(k), word)]).alias("m"),
    )
    return made.groupBy(
        F.col("a")[0].alias("word"), F.col("a")[1].alias("added"), F.size("a").cast("bigint").alias("n_fields"),
        F.col("s").getField("name").alias("name"), F.col("m")["key1"].alias("key1"), F.col("m")["key3"].alias("key3"),
    ).agg(n_rows())


@query("by_event_folders", with_events("SELECT event, count(*) AS n FROM events_log WHERE event = 'departed' GROUP BY event"))
def by_event_folders(spark, sf):
    """Events written to one folder per type; reading one type opens its folder only."""
    path = scratch(spark, "by-event")
    file_sink.write_by_event(sample.event_log(spark, sf), path)
    log = tables.read_event_log(spark, path, F.col("event") == "departed", ["event"])
    return log.groupBy("event").agg(n_rows())
