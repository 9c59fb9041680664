"""Streaming queries over the activity table, compared with their batch meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tarmac.catalog.checksql import text, with_events
from tarmac.catalog.registry import query, rounded
from tarmac.functions.times import time_text
from tarmac.plans.messages import stream_to_text_and_table
from tarmac.session import scratch
from tarmac.sinks.windowed_text import read_windows, write_windows
from tarmac.sources import sample
from tarmac.sources.streams import Arrivals, read_files
from tarmac.streaming import lateness, messages, panes, replay, runs, windows


def _events(spark, sf, streaming: bool) -> DataFrame:
    """Activity rows read as flights: users are destinations, clicks and views arrivals."""
    schema: StructType = sample.table(spark, sf, "events").schema
    # As a pattern the path may be one file as well as a folder of files.
    rows = read_files(spark, f"{sf}/events.parquet*", schema, streaming)
    return rows.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("D"), (F.col("user_id") % 20).cast("string")).alias("dest"),
        F.when(F.col("event_type").isin("click", "view"), "arrived").otherwise("departed").alias("event"),
        F.col("value").alias("arr_delay"),
    )


def _arriving(spark, sf, days: int = 20, arrival=None) -> Arrivals:
    """The same rows in blocks of days, each one drain of the stream."""
    return Arrivals(_events(spark, sf, False), days, arrival)


BASE_SQL = """
base AS (
  SELECT event_id, ts, 'D' || (user_id % 20) AS dest,
    CASE WHEN event_type IN ('click', 'view') THEN 'arrived' ELSE 'departed' END AS event, value AS arr_delay,
    (epoch_us(ts) // 300000000) * 300 AS slot
  FROM events)"""


def _arrival():
    return F.when(F.col("event") == "arrived", F.col("arr_delay"))


@query("stamped_messages", f"""WITH {BASE_SQL}
SELECT event || ',' || dest AS message, count(*) AS n, count(*) AS n_stamped FROM base GROUP BY 1""")
def stamped_messages(spark, sf):
    stream = _events(spark, sf, True).select(F.concat_ws(",", "event", "dest").alias("message"))
    out = runs.collected(spark, messages.stamp(stream), "stamped")
    return out.groupBy("message").agg(
        F.count(F.lit(1)).alias("n"), F.count("timestamp").alias("n_stamped"))


@query("stamped_lines", f"""WITH {BASE_SQL}
SELECT event AS event, count(*) AS n, count(*) AS n_stamped FROM base GROUP BY 1""")
def stamped_lines(spark, sf):
    stream = _events(spark, sf, True).select(F.col("event").alias("message"))
    out = runs.collected(spark, messages.stamp_lines(stream), "stamped-lines")
    pattern = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d (\w+)$"
    return out.groupBy(F.element_at(F.split("value", " "), -1).alias("event")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").rlike(pattern)).alias("n_stamped"))


MINUTE_SQL = f"""WITH {BASE_SQL}
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event, count(*) AS n
FROM base {{where}} GROUP BY 1, 2"""


@query("minute_counts_stream", MINUTE_SQL.format(where=""))
def minute_counts_stream(spark, sf):
    """Every window once, when the watermark has passed it."""
    rows = _arriving(spark, sf)
    out = runs.collected(spark, messages.window_counts(rows.stream, ["event"]), "minute-counts", arrivals=rows)
    return out.select(time_text("window_start").alias("window_start"), "event", "n")


@query("early_counts_stream", MINUTE_SQL.format(where=""))
def early_counts_stream(spark, sf):
    """Open windows too: the newest update of each."""
    path, rows = scratch(spark, "early-counts"), _arriving(spark, sf, 8)
    counts = messages.window_counts(rows.stream, ["event"])
    for _ in rows:
        runs.each_batch(counts, runs.batch_folder(f"{path}/out"), f"{path}/state", mode="update")
    updates = spark.read.parquet(f"{path}/out").where("event IS NOT NULL")
    final = messages.latest(updates, ["window_start", "event"])
    return final.select(time_text("window_start").alias("window_start"), "event", "n")


#: Panes of an hour, so that a window is fired more than once.
@query("pane_counts_stream", f"""WITH {BASE_SQL}
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event, count(*) AS n, 0::BIGINT AS n_untimely
FROM base GROUP BY 1, 2""")
def pane_counts_stream(spark, sf):
    """Firings of every window add up to it; none comes before it is due."""
    path, rows, delay = scratch(spark, "panes"), _arriving(spark, sf, 8), 1.0
    with panes.timers(spark):
        out = panes.fired(rows.stream, ["event"], width="1 hour", delay=delay, poll=0.5)
        query = runs.append_files(out, f"{path}/out", f"{path}/state", drain=False)
        try:
            for _ in rows:
                runs.until_quiet(query)
        finally:
            query.stop()
    found = spark.read.schema(out.schema).parquet(f"{path}/out").where("event IS NOT NULL")
    early = F.col("fired_at") - F.col("first_at") < int(1000 * delay)
    untimely = ((F.col("kind") == "early") & early) | ((F.col("kind") == "final") & (F.unix_millis("window_start") + 3_600_000 > F.col("watermark")))
    return found.where("kind <> 'late'").groupBy(time_text("window_start").alias("window_start"), "event").agg(
        F.sum("n").alias("n"), F.count_if(untimely).alias("n_untimely"))


#: Every tenth event arrives nine days after it happened; a block of eight days is one batch.
LATE_SQL = f"""WITH {BASE_SQL}, arriving AS (
  SELECT *, (epoch_us(ts) // 1000000 + CASE WHEN event_id % 10 = 0 THEN 777600 ELSE 0 END) // 691200 AS block FROM base
), high AS (SELECT block, max(max(ts)) OVER (ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM arriving GROUP BY block)
SELECT event_id, event, coalesce(date_trunc('minute', ts) + INTERVAL 1 MINUTE <= high, false) AS late FROM arriving JOIN high USING (block)"""


@query("late_rows_stream", LATE_SQL)
def late_rows_stream(spark, sf):
    """On-time and late rows, each in an output of its own, are all rows."""
    delayed = F.when(F.col("event_id") % 10 == 0, F.col("ts") + F.expr("INTERVAL 9 DAYS")).otherwise(F.col("ts"))
    path, rows = scratch(spark, "late"), _arriving(spark, sf, 8, delayed)
    for _ in rows:
        lateness.split_late(rows.stream, path, f"{path}/state")
    found = lateness.split_rows(spark, rows.stream, path)
    return found.where("event_id IS NOT NULL").select("event_id", "event", "late")


@query("windowed_files_stream", f"""WITH {BASE_SQL}
SELECT strftime(date_trunc('minute', ts), '%Y%m%d%H%M') AS window_start, event || ',' || dest || ',' || event_id AS line FROM base""")
def windowed_files_stream(spark, sf):
    """Messages in one text file per minute."""
    path, rows = scratch(spark, "windowed"), _arriving(spark, sf, 8)
    lines = rows.stream.select("ts", F.concat_ws(",", "event", "dest", "event_id").alias("line"))
    for _ in rows:
        write_windows(lines, f"{path}/out", path)
    return read_windows(spark, f"{path}/out")


@query("text_and_table_stream", f"""WITH {BASE_SQL}
SELECT event || ',' || dest AS message, count(*) AS n_lines, count(*) AS n_rows, count(DISTINCT date_trunc('hour', ts)) AS n_files FROM base GROUP BY 1""")
def text_and_table_stream(spark, sf):
    """The job with both outputs: stamped lines by hour, stamped rows in a table."""
    path, rows = scratch(spark, "text-and-table"), _arriving(spark, sf)
    stream = rows.stream.select("ts", F.concat_ws(",", "event", "dest").alias("message"))
    for _ in rows:
        stream_to_text_and_table(stream, f"{path}/out", f"{path}/state", width="1 hour")
    message = F.regexp_extract("line", r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d (.*)$", 1)
    lines = read_windows(spark, f"{path}/out/text").groupBy(message.alias("message")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("window_start").alias("n_files"))
    table = spark.read.parquet(f"{path}/out/table").groupBy("message").agg(F.count("timestamp").alias("n_rows"))
    return lines.join(table, "message").select("message", "n_lines", "n_rows", "n_files")


SLIDING_SQL = f"""WITH {BASE_SQL}
SELECT strftime(make_timestamp(w * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start, dest,
  round(avg(v), 6) AS mean, count(v) AS n
FROM (SELECT dest, CASE WHEN event = 'arrived' THEN arr_delay END AS v, unnest(range(slot - 3300, slot + 1, 300)) AS w
  FROM base)
{{where}} GROUP BY w, dest"""


@query("sliding_stream", SLIDING_SQL.format(where=""))
def sliding_stream(spark, sf):
    rows = _arriving(spark, sf)
    out = runs.collected(spark, windows.sliding_averages(rows.stream, "dest", _arrival()), "sliding", arrivals=rows)
    return rounded(
        out.select(time_text("window_start").alias("window_start"), "dest", "mean", "n"), "mean")


@query("cogroup_stream", f"""WITH {BASE_SQL}
SELECT e.event_id, e.dest, round(coalesce(avg(a.arr_delay), 0), 6) AS mean
FROM base e LEFT JOIN base a
  ON a.dest = e.dest AND a.event = 'arrived' AND a.slot BETWEEN e.slot - 3300 AND e.slot
GROUP BY e.event_id, e.dest""")
def cogroup_stream(spark, sf):
    """Every event once, with the mean of its closed window, from the stream alone."""
    rows = _arriving(spark, sf)
    out = runs.collected(spark, windows.enriched(rows.stream, "dest", _arrival()), "cogroup", arrivals=rows)
    return rounded(out.select("event_id", "dest", "mean"), "mean")


@query("events_by_type_stream", f"""WITH {BASE_SQL}
SELECT event, count(*) AS n, max(event_id) AS last_id FROM base GROUP BY event""")
def events_by_type_stream(spark, sf):
    """One output folder per event type."""
    out = runs.collected(spark, _events(spark, sf, True), "by-type", ["event"])
    return out.groupBy("event").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"))


@query("stream_as_batch", f"""WITH {BASE_SQL}
SELECT strftime(make_timestamp(w * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start, dest,
  round(avg(v), 6) AS mean, count(v) AS n
FROM (SELECT dest, CASE WHEN event = 'arrived' THEN arr_delay END AS v, unnest(range(slot - 3300, slot + 1, 300)) AS w
  FROM base)
GROUP BY w, dest""")
def stream_as_batch(spark, sf):
    """The streaming transformation applied to the bounded table."""
    means = windows.sliding_averages(_events(spark, sf, False), "dest", _arrival())
    return rounded(
        means.select(time_text("window_start").alias("window_start"), "dest", "mean", "n"), "mean")


@query("replay_schedule", with_events(f"""
SELECT op_carrier_fl_num, event, {text('notify_time')} AS notify_time,
  round((epoch(notify_time) - epoch(TIMESTAMP '2018-02-10 00:00:00')) / 60.0::DOUBLE, 6) AS release_sec,
  strftime(notify_time, '%Y-%m-%dT%H:%M:%SZ') AS stamp
FROM events_log WHERE notify_time >= TIMESTAMP '2018-02-10 00:00:00' AND notify_time < TIMESTAMP '2018-02-13 00:00:00'"""))
def replay_schedule(spark, sf):
    due = replay.schedule(sample.event_log(spark, sf), "2018-02-10 00:00:00", "2018-02-13 00:00:00", 60)
    return due.select(
        "op_carrier_fl_num", "event", time_text("notify_time").alias("notify_time"),
        F.round("release_sec", 6).alias("release_sec"), "stamp")
