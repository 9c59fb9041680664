"""Streams over several files and batches, compared with their batch meaning."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tarmac.operators import windows as batch_windows
from tarmac.plans.messages import stream_to_text_and_table
from tarmac.sinks.windowed_text import WindowedText, read_windows, write_windows
from tarmac.sources.streams import Arrivals, read_files
from tarmac.streaming import lateness, messages, panes, replay, runs, windows
from test_windows import make_events

SCHEMA = "id int, dest string, event string, ts timestamp, arr_delay double"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Three files in time order, so that the watermark moves between batches."""
    path = str(tmp_path_factory.mktemp("stream") / "events")
    rows = sorted(make_events(1500, 3), key=lambda r: r[3])
    for i in range(3):
        part = spark.createDataFrame(rows[i * 500:(i + 1) * 500], SCHEMA)
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def source(spark, folder, streaming=True):
    schema = spark.createDataFrame([], SCHEMA).schema
    return read_files(spark, folder, schema, streaming, files_per_batch=1 if streaming else None)


def arrival():
    return F.when(F.col("event") == "arrived", F.col("arr_delay"))


def test_minute_counts_over_batches(spark, folder):
    out = runs.collected(spark, messages.window_counts(source(spark, folder), ["event"]), "t")
    batch = messages.window_counts(source(spark, folder, False), ["event"])
    last = source(spark, folder, False).agg(F.max("ts")).first()[0]
    closed = batch.where(F.col("window_end") <= F.lit(last))
    assert out.exceptAll(closed).count() == 0 and closed.exceptAll(out).count() == 0


def test_enriched_events_over_batches(spark, folder):
    """Three files and no closing row: the events of closed windows, each once, from the stream alone."""
    stored = source(spark, folder, False)
    out = runs.collected(spark, windows.enriched(source(spark, folder), "dest", arrival(), name="avg_arr_delay"), "t")
    whole = batch_windows.with_arrival_average(stored.withColumnRenamed("ts", "notify_time"))
    assert out.count() == out.select("id").distinct().count()
    last = stored.agg(F.unix_timestamp(F.max("ts"))).first()[0]
    due = whole.where(F.unix_timestamp("notify_time") - F.unix_timestamp("notify_time") % 300 + 300 <= last)
    joined = due.select("id", F.col("avg_arr_delay").alias("want")).join(
        out.select("id", F.col("avg_arr_delay").alias("got")), "id", "full")
    assert joined.where("want IS NULL OR got IS NULL OR abs(want - got) > 1e-9").count() == 0


def test_arrivals_make_the_drain_whole(spark, folder):
    batch = source(spark, folder, False).withColumn("dest", F.when(F.col("id") % 50 > 0, F.col("dest")))
    rows = Arrivals(batch, 1)
    out = runs.collected(spark, messages.window_counts(rows.stream, ["event"]), "t", arrivals=rows)
    want = messages.window_counts(batch, ["event"])
    assert out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0
    rows = Arrivals(batch, 2)
    found = runs.collected(spark, windows.enriched(rows.stream, "dest", arrival(), salts=2), "t", arrivals=rows)
    assert sorted(r.id for r in found.select("id").collect()) == sorted(r.id for r in batch.select("id").collect())


def test_enriching_an_empty_stream(spark):
    rows = Arrivals(spark.createDataFrame([], SCHEMA), 1)
    out = runs.collected(spark, windows.enriched(rows.stream, "dest", arrival()), "t", arrivals=rows)
    assert out.count() == 0 and out.columns[-1] == "mean"


def test_late_rows_are_dropped(spark, tmp_path):
    path = str(tmp_path / "late")
    t = dt.datetime(2018, 1, 1, 10, 0)
    minutes = lambda n: t + dt.timedelta(minutes=n)
    # A window closed in one batch refuses rows from the next batch on.
    for i, moments in enumerate([[t, minutes(30)], [minutes(31)], [t + dt.timedelta(seconds=5)], [minutes(120)]]):
        rows = [(i, "A", "arrived", m, 1.0) for m in moments]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    out = runs.collected(spark, messages.window_counts(source(spark, path), ["dest"]), "t")
    counts = {r["window_start"]: r["n"] for r in out.collect()}
    assert counts == {t: 1, minutes(30): 1, minutes(31): 1}


def counted(df, *keys):
    return {tuple(r[k] for k in keys): r["n"] for r in df.collect()}


def test_updates_end_in_the_whole(spark, folder, tmp_path):
    window = F.window("ts", "1 minute")["start"].alias("window_start")
    want = counted(source(spark, folder, False).groupBy(window, "event").agg(F.count(F.lit(1)).alias("n")), "window_start", "event")
    write = runs.batch_folder(str(tmp_path / "up"))
    runs.each_batch(messages.window_counts(source(spark, folder), ["event"]), write, str(tmp_path / "s1"), "update")
    final = messages.latest(spark.read.parquet(str(tmp_path / "up")), ["window_start", "event"])
    assert counted(final, "window_start", "event") == want


def test_panes_fire_when_due_and_add_up(spark, tmp_path):
    """Hours of rows over several batches: a row for a window already fired comes in a pane of its own."""
    t = dt.datetime(2018, 1, 1, 10)
    at = lambda m: t + dt.timedelta(minutes=m)
    steps = [[(1, at(1)), (2, at(2))], [(3, at(3))], [(4, at(61)), (5, at(200))], [(6, at(4)), (7, at(201))]]
    path = str(tmp_path / "rows")
    spark.createDataFrame([], "id int, ts timestamp").write.parquet(path)
    stream = spark.readStream.schema("id int, ts timestamp").parquet(path).withColumn("key", F.lit("k"))
    with panes.timers(spark):
        out = panes.fired(stream, ["key"], width="1 hour", delay=1.5, poll=0.5)
        query = runs.append_files(out, str(tmp_path / "out"), str(tmp_path / "state"), drain=False)
        try:
            for rows in steps:
                spark.createDataFrame(rows, "id int, ts timestamp").coalesce(1).write.mode("append").parquet(path)
                runs.until_quiet(query, 120)
        finally:
            query.stop()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    by = lambda kind, hour: [r.n for r in found if r.kind == kind and r.window_start == at(60 * hour)]
    # The first two steps fire early, one pane each; row 4's window closes, or fires early, in a batch of its own; row 6 is late.
    assert sorted(by("early", 0) + by("final", 0)) == [1, 2] and by("late", 0) == [1]
    assert sum(by("early", 1) + by("final", 1)) == 1 and sum(by("early", 3)) == 2
    assert sum(r.n for r in found) == 7
    for r in found:
        if r.kind == "early":
            assert r.fired_at - r.first_at >= 1500
        if r.kind == "final":
            assert r.watermark >= (r.window_start + dt.timedelta(hours=1) - dt.datetime(1970, 1, 1)).total_seconds() * 1000


def test_late_rows_are_told_apart_at_once(spark, tmp_path):
    path, out = str(tmp_path / "rows"), str(tmp_path / "out")
    t = dt.datetime(2018, 1, 1, 10)
    at = lambda s: t + dt.timedelta(seconds=s)
    spark.createDataFrame([], "id int, ts timestamp").write.parquet(path)
    stream = spark.readStream.schema("id int, ts timestamp").parquet(path)
    # Row 3 comes in the batch right after the one that closed its window; row 5's window is still open.
    for rows in ([(1, at(0)), (2, at(61))], [(3, at(5)), (4, at(62)), (5, at(60))], [(6, None), (7, at(500)), (8, at(3))]):
        spark.createDataFrame(rows, "id int, ts timestamp").coalesce(1).write.mode("append").parquet(path)
        lateness.split_late(stream, out, str(tmp_path / "state"))
    got = {r.id: r.late for r in lateness.split_rows(spark, stream, out).collect()}
    assert got == {1: False, 2: False, 3: True, 4: False, 5: False, 6: True, 7: False, 8: True}


def test_one_text_file_per_window(spark, folder, tmp_path):
    out, work = str(tmp_path / "out"), str(tmp_path / "work")
    rows = Arrivals(source(spark, folder, False), 1)
    lines = rows.stream.select("ts", F.concat_ws(",", "id", "event").alias("line"))
    for _ in rows:
        write_windows(lines, out, work)
    want = source(spark, folder, False).select(F.date_format("ts", "yyyyMMddHHmm"), F.concat_ws(",", "id", "event")).collect()
    assert sorted(tuple(r) for r in read_windows(spark, out).collect()) == sorted(tuple(r) for r in want)
    files = [f for f in os.listdir(out) if f.endswith(".txt")]
    assert len(files) == len({r[0] for r in want}) and not os.listdir(f"{work}/rows/staged")


def test_a_repeated_batch_writes_the_same_files(spark, tmp_path):
    out, work = str(tmp_path / "out"), str(tmp_path / "work")
    t = dt.datetime(2018, 1, 1, 10)
    make = lambda rows: spark.createDataFrame([(t + dt.timedelta(seconds=s), x) for s, x in rows], "ts timestamp, line string")
    first, second = make([(1, "b"), (1, "a"), (59, None), (70, "c")]), make([(80, "d"), (3, "late"), (200, "e")])
    sink = WindowedText(spark, out, work)
    for batch, number in ((first, 0), (first, 0), (second, 1), (second, 1)):
        sink(batch, number)
    texts = {name: open(f"{out}/{name}").read() for name in os.listdir(out) if name.endswith(".txt")}
    assert texts == {"201801011000.txt": "a\nb\n\n", "201801011001.txt": "c\nd\n"}


def test_text_and_table(spark, folder, tmp_path):
    rows = Arrivals(source(spark, folder, False), 2)
    stream = rows.stream.select("ts", F.concat_ws(",", "dest", "event").alias("message"))
    for _ in rows:
        stream_to_text_and_table(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    texts = read_windows(spark, str(tmp_path / "out/text"))
    stamped = spark.read.parquet(str(tmp_path / "out/table"))
    assert texts.count() == 1500 and stamped.count() == 1501
    assert texts.where(F.col("line").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d ")).count() == 1500
    assert dict(stamped.dtypes)["timestamp"] == "timestamp_ntz"
    assert texts.select("window_start").distinct().count() > 10


def test_stream_resumes_where_it_stopped(spark, folder, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        runs.append_files(source(spark, folder), out, state)
    assert spark.read.parquet(out).count() == 1500


def test_replay_schedule(spark, folder):
    rows = source(spark, folder, False).withColumnRenamed("ts", "notify_time")
    due = replay.schedule(rows, "2018-01-01 23:00:00", "2018-01-03 00:00:00", speed=60).collect()
    assert [r["release_sec"] for r in due] == sorted(r["release_sec"] for r in due)
    first = due[0]
    assert first["release_sec"] == (first["notify_time"] - dt.datetime(2018, 1, 1, 23)).total_seconds() // 1 / 60
    assert all(dt.datetime(2018, 1, 1, 23) <= r["notify_time"] < dt.datetime(2018, 1, 3) for r in due)
