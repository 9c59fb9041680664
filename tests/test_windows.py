"""Window operators against brute force, also with one dominant key."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tarmac.operators import explore, windows
from tarmac.functions.predicates import is_arrived

START = dt.datetime(2018, 1, 1, 22, 0)


def make_events(n, seed, hot=0.4):
    """Events over several days around midnight; `hot` of them at one airport."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        dest = "HOT" if rng.random() < hot else rng.choice("ABCDE")
        day = rng.choice([0, 0, 1, 3])
        when = START + dt.timedelta(days=day, seconds=rng.randrange(0, 5 * 3600))
        if rng.random() < 0.2:
            when = when.replace(second=0, minute=when.minute // 5 * 5)
        arrived = rng.random() < 0.6
        rows.append((i, dest, "arrived" if arrived else "departed", when, float(rng.randrange(-20, 60)) if arrived else None))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_events(3000, 7)


@pytest.fixture(scope="module")
def events(spark, rows):
    return spark.createDataFrame(rows, "id int, dest string, event string, notify_time timestamp, arr_delay double")


def slot_of(when):
    seconds = int((when - dt.datetime(1970, 1, 1)).total_seconds())
    return seconds - seconds % 300


def brute(rows, reach):
    by_dest = defaultdict(list)
    for _, dest, event, when, delay in rows:
        if event == "arrived":
            by_dest[dest].append((slot_of(when), delay))
    out = {}
    for i, dest, _, when, _ in rows:
        s = slot_of(when)
        hits = [d for t, d in by_dest[dest] if s - reach <= t <= s]
        out[i] = round(sum(hits) / len(hits), 9) if hits else 0.0
    return out


def result(df):
    return {r["id"]: round(r["avg_arr_delay"], 9) for r in df.select("id", "avg_arr_delay").collect()}


def test_trailing_hour(events, rows):
    assert result(windows.with_arrival_average(events)) == brute(rows, 3300)


def test_slice(events, rows):
    assert result(windows.with_arrival_average(events, mean_over="slice")) == brute(rows, 0)


def test_last_minute_keeps_the_end_of_a_slot(events, rows):
    kept = [r for r in rows if slot_of(r[3]) + 300 - int((r[3] - dt.datetime(1970, 1, 1)).total_seconds()) <= 60]
    got = windows.with_arrival_average(events, mean_over="slice", slice_minutes=1)
    assert result(got) == brute(kept, 0)


def test_equal_to_literal_sliding_windows(events):
    literal = (
        events.where(is_arrived()).groupBy("dest", F.window("notify_time", "1 hour", "5 minutes").alias("w"))
        .agg(F.avg("arr_delay").alias("mean"), F.count("arr_delay").alias("n"))
        .select("dest", F.unix_timestamp("w.start").alias("window_start"), F.round("mean", 9).alias("mean"), "n")
    )
    totals = windows.slot_totals(events, "dest", F.when(is_arrived(), F.col("arr_delay")))
    ours = windows.sliding_means(totals, "dest").select("dest", "window_start", F.round("mean", 9).alias("mean"), "n")
    assert ours.exceptAll(literal).count() == 0 and literal.exceptAll(ours).count() == 0


def test_slice_keeps_one_window_per_event(events):
    copies = events.withColumn("w", F.window("notify_time", "1 hour", "5 minutes"))
    slack = F.unix_timestamp("w.end") - F.unix_timestamp("notify_time")
    assert copies.count() == 12 * events.count()
    assert copies.where(slack <= 300).count() == events.count()


def test_per_window_gives_twelve_rows(events):
    out = windows.per_window(events)
    assert out.count() == 12 * events.count()
    newest = out.where(F.col("window_start") == F.unix_timestamp("notify_time") - F.unix_timestamp("notify_time") % 300 - 3300)
    both = newest.select("id", F.col("avg_arr_delay").alias("a")).join(
        windows.with_arrival_average(events).select("id", F.col("avg_arr_delay").alias("b")), "id")
    assert both.where(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0


def test_frame_partitions_are_at_most_a_day(events):
    totals = windows.slot_totals(events, "dest", F.col("arr_delay"))
    plan = windows.trailing_means(totals, "dest", "m")._jdf.queryExecution().executedPlan().toString()
    assert "part" in plan.split("Window", 1)[1].split("\n", 1)[0]


def test_no_events(spark, events):
    assert windows.with_arrival_average(events.where("id < 0")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_discrete_quantiles(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice("xy"), float(rng.randrange(8)) if rng.random() < 0.9 else None) for _ in range(500)]
    df = spark.createDataFrame(data, "k string, v double")
    qs = [0, 0.1, 70 / 101, 0.5, 1]
    for r in explore.discrete_quantiles(df, "v", qs, ["k"]).collect():
        values = sorted(v for k, v in data if k == r["k"] and v is not None)
        want = [values[max(1, -int(-(len(values) * q) // 1)) - 1] for q in qs]
        assert r["quantiles"] == want and r["n"] == len(values)


def test_ranged_quantiles(spark):
    rng = random.Random(9)
    values = [rng.gauss(0, 100) for _ in range(3000)] + [7.5] * 2000
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(7)
    qs = [i / 20 for i in range(21)] + [0.333]
    got = {r["position"]: r["value"] for r in explore.ranged_quantiles(df, "v", qs).collect()}
    values.sort()
    assert got == {i: values[max(1, -int(-(len(values) * q) // 1)) - 1] for i, q in enumerate(qs)}
    plan = explore.ventiles(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert explore.ranged_quantiles(df.where("false"), "v", qs).count() == 0


def test_bad_mode(events):
    with pytest.raises(ValueError):
        windows.with_arrival_average(events, mean_over="day")
