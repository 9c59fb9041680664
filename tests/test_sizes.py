"""What jobs write and shuffle: packed text, cells made after the shuffle, folders without a sort."""

import glob
import uuid

from pyspark.sql import functions as F

from tarmac import session
from tarmac.catalog import QUERIES, storage
from tarmac.functions.text import event_payload
from tarmac.operators.events import event_lines
from tarmac.operators.windows import with_arrival_average
from tarmac.plans import ingest
from tarmac.sinks import cells, files as file_sink, tables
from tarmac.sources import sample


def test_corrected_lines_are_packed_and_days_kept_together(spark, sf_dir, tmp_path):
    ingest.correct_and_log(
        sample.flights(spark, sf_dir), sample.zoned_airports(spark, sf_dir), f"{tmp_path}/corrected", f"{tmp_path}/log")
    parts = glob.glob(f"{tmp_path}/corrected/part-*")
    assert parts and all(p.endswith(".txt.gz") for p in parts)
    assert spark.read.text(f"{tmp_path}/corrected").count() == sample.flights(spark, sf_dir, "fl_date").count()
    assert len(glob.glob(f"{tmp_path}/log/fl_date=*")) == sample.N_DAYS
    assert spark.read.parquet(f"{tmp_path}/log").count() == sample.event_log(spark, sf_dir).count()


def test_folders_hold_all_rows_and_leave_the_setting(spark, tmp_path):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    rows = spark.range(0, 1000, 1, 3).select("id", (F.col("id") % 5).alias("k"))
    tables.write_folders(rows, f"{tmp_path}/few", "k", at_once=8)
    tables.write_folders(rows, f"{tmp_path}/many", "k", at_once=2)
    for name in ("few", "many"):
        assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/{name}").collect())) == sorted((i, i % 5) for i in range(1000))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_events_reach_their_folders_without_a_sort(spark, tmp_path):
    """One task, types in turn: sorted by type, a folder's rows would not change, but the setting must be in force."""
    seen = []
    rows = spark.range(0, 10, 1, 1).select("id", F.when(F.col("id") % 2 == 0, "departed").otherwise("arrived").alias("event"))

    class Conf:
        def __getattr__(self, name):
            return getattr(spark.conf, name)

        def set(self, key, value):
            seen.append((key, str(value)))
            spark.conf.set(key, value)

    class Session:
        conf = Conf()

    class Rows:
        sparkSession, write = Session(), rows.write

    file_sink.write_by_event(Rows(), f"{tmp_path}/by-event")
    assert ("spark.sql.maxConcurrentOutputFileWriters", "8") in seen
    assert spark.read.parquet(f"{tmp_path}/by-event").groupBy("event").count().where("count = 5").count() == 2


def test_lines_packed_on_request(spark, tmp_path):
    rows = spark.range(5).select(F.col("id").cast("string").alias("value"))
    file_sink.write_csv(rows, f"{tmp_path}/csv", packed=True)
    assert all(p.endswith(".csv.gz") for p in glob.glob(f"{tmp_path}/csv/part-*"))
    assert spark.read.csv(f"{tmp_path}/csv").count() == 5


def test_cells_of_predictions_are_in_key_order(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(cells, "SORTED_AT_ONCE", 3000)
    made = sample.event_log(spark, sf_dir).withColumn("ontime", F.lit(0.5))
    cells.write_cells(made, f"{tmp_path}/cells")
    back = spark.read.parquet(f"{tmp_path}/cells")
    assert back.exceptAll(cells.prediction_cells(made)).isEmpty() and cells.prediction_cells(made).exceptAll(back).isEmpty()
    parts = glob.glob(f"{tmp_path}/cells/part-*")
    assert len(parts) > 2
    for p in parts[:3]:
        keys = [tuple(r) for r in spark.read.parquet(p).select("row_key", "qualifier").collect()]
        assert keys == sorted(keys)


def test_events_are_not_shuffled_for_their_averages(spark, sf_dir):
    joined = with_arrival_average(sample.event_log(spark, sf_dir).select("dest", "event", "notify_time", "arr_delay"))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Window" not in plan


def test_event_lines_equal_payloads(spark, sf_dir):
    want = sample.event_log(spark, sf_dir).select(event_payload().alias("value"))
    got = event_lines(sample.corrected(spark, sf_dir))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_stored_events_are_read_from_a_table(spark, sf_dir):
    got = sample.stored_events(spark, sf_dir, "origin", "event")
    assert got.columns == ["origin", "event"] and "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.count() == sample.event_log(spark, sf_dir).count()


def test_texts_of_cells_are_made_once(spark, sf_dir):
    made = sample.event_log(spark, sf_dir).withColumn("ontime", F.lit(0.5))
    plan = cells.prediction_cells(made)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and "size(array(" not in plan


def test_cells_of_arranged_predictions_keep_their_ranges(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(cells, "SORTED_AT_ONCE", 1500)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    made = sample.event_log(spark, sf_dir).withColumn("ontime", F.lit(0.5))
    cells.by_key(made, made.count()).write.parquet(f"{tmp_path}/decided")
    stored = spark.read.schema(made.schema).parquet(f"{tmp_path}/decided")
    cells.write_cells(stored, f"{tmp_path}/cells", arranged=True)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    back = spark.read.parquet(f"{tmp_path}/cells")
    assert back.exceptAll(cells.prediction_cells(made)).isEmpty() and cells.prediction_cells(made).exceptAll(back).isEmpty()
    parts = glob.glob(f"{tmp_path}/cells/part-*.zstd.parquet")
    assert len(parts) == len(glob.glob(f"{tmp_path}/decided/part-*")) > 4
    keys = [[tuple(r) for r in spark.read.parquet(p).select("row_key", "qualifier").collect()] for p in parts]
    assert all(k == sorted(k) for k in keys)
    ranges = sorted((k[0][0], k[-1][0]) for k in keys)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_cells_of_no_predictions(spark, sf_dir, tmp_path):
    none = sample.event_log(spark, sf_dir).withColumn("ontime", F.lit(0.5)).where("event = 'neither'")
    cells.by_key(none, 0).write.parquet(f"{tmp_path}/decided")
    stored = spark.read.schema(none.schema).parquet(f"{tmp_path}/decided")
    cells.write_cells(stored, f"{tmp_path}/cells", arranged=True)
    assert spark.read.parquet(f"{tmp_path}/cells").isEmpty()


def test_corrected_lines_of_the_round_trip_are_packed(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "scratch", lambda spark, label: f"{tmp_path}/{label}")
    found = QUERIES["corrected_csv_roundtrip"](spark, sf_dir)
    parts = glob.glob(f"{tmp_path}/corrected-csv/part-*")
    assert parts and all(p.endswith(".txt.gz") for p in parts)
    assert found.agg(F.sum("n")).first()[0] == sample.flights(spark, sf_dir, "fl_date").count()


def test_months_are_published_as_gzip_and_leave_no_lines(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "scratch", lambda spark, label: f"{tmp_path}/{label}")
    monkeypatch.setattr(session, "scratch", lambda spark, label: f"{tmp_path}/stored/{label}-{uuid.uuid4().hex}")
    found = QUERIES["monthly_ingest"](spark, sf_dir)
    assert found.agg(F.sum("n")).first()[0] == sample.flights(spark, sf_dir, "fl_date").count()
    parts = glob.glob(f"{tmp_path}/monthly/raw/*.csv/part-*")
    assert parts and all(p.endswith(".txt.gz") for p in parts)
    assert not glob.glob(f"{tmp_path}/stored/ingest-*") and not glob.glob(f"{tmp_path}/monthly/lines")


def test_corrected_flights_are_stored_packed_and_go_after_the_outputs(spark, sf_dir, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(session, "scratch", lambda spark, label: f"{tmp_path}/stored/{label}-{uuid.uuid4().hex}")
    forget = ingest.forget
    monkeypatch.setattr(ingest, "forget", lambda stored: (seen.extend(stored.inputFiles()), forget(stored)))
    ingest.correct_and_log(
        sample.flights(spark, sf_dir), sample.zoned_airports(spark, sf_dir), f"{tmp_path}/corrected", f"{tmp_path}/log")
    assert seen and all(f.endswith(".zstd.parquet") for f in seen)
    assert not glob.glob(f"{tmp_path}/stored/corrected-*")


def test_cells_of_a_prediction_come_in_order(spark, sf_dir):
    made = sample.event_log(spark, sf_dir).withColumn("ontime", F.lit(0.5)).limit(1)
    names = [r["qualifier"] for r in cells.prediction_cells(made).collect()]
    assert len(names) > 20 and names == sorted(names)
