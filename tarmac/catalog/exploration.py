"""Delay statistics, decision tables, binned probabilities, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.catalog.checksql import with_raw
from tarmac.catalog.registry import query, rounded
from tarmac.functions.features import scaled
from tarmac.functions.predicates import flown, has_delays
from tarmac.operators import bayes, explore, sampling
from tarmac.operators.lookups import join_days
from tarmac.sources import sample

DELAYS = ("dep_delay", "arr_delay")
BY_DELAY = """(SELECT dep_delay, avg(arr_delay) AS arrival_delay,
    stddev_samp(arr_delay) AS stddev_arrival_delay, count(arr_delay) AS numflights
  FROM raw GROUP BY dep_delay)"""


def _test_days(spark, sf, *columns):
    return join_days(sample.flights(spark, sf, "fl_date", *columns), sample.train_days(spark), False)


def _train_days(spark, sf, *columns):
    return join_days(sample.flights(spark, sf, "fl_date", *columns), sample.train_days(spark), True)


@query("delay_by_departure_delay", with_raw(f"""
SELECT dep_delay, round(arrival_delay, 6) AS arrival_delay,
  round(stddev_arrival_delay, 6) AS stddev_arrival_delay, numflights
FROM {BY_DELAY} WHERE numflights > 370 ORDER BY dep_delay"""))
def delay_by_departure_delay(spark, sf):
    table = explore.frequent_delays(sample.flights(spark, sf, *DELAYS))
    return rounded(table, "arrival_delay", "stddev_arrival_delay").orderBy("dep_delay")


@query("delay_by_departure_delay_all", with_raw(f"""
SELECT dep_delay, round(arrival_delay, 6) AS arrival_delay,
  round(stddev_arrival_delay, 6) AS stddev_arrival_delay, numflights FROM {BY_DELAY}"""))
def delay_by_departure_delay_all(spark, sf):
    table = explore.by_departure_delay(sample.flights(spark, sf, *DELAYS))
    return rounded(table, "arrival_delay", "stddev_arrival_delay")


@query("delay_count_max", with_raw("""
SELECT count(*) AS n_rows, count(dep_delay) AS n_dep_delay, count(arr_delay) AS n_arr_delay,
  max(dep_delay) AS max_dep_delay, count(*) FILTER (WHERE dep_delay > 10) AS n_dep_after_10 FROM raw"""))
def delay_count_max(spark, sf):
    return explore.counts(sample.flights(spark, sf, *DELAYS))


@query("three_sigma_bounds", with_raw("""
SELECT round(avg(dep_delay) - 3 * stddev_samp(dep_delay), 6) AS flights_min,
  round(avg(dep_delay) + 3 * stddev_samp(dep_delay), 6) AS flights_max FROM raw"""))
def three_sigma_bounds(spark, sf):
    return rounded(explore.sigma_bounds(sample.flights(spark, sf, "dep_delay")), "flights_min", "flights_max")


def _describe_sql(where: str) -> str:
    return with_raw(" UNION ALL ".join(
        f"""SELECT '{c}' AS metric, count({c}) AS n, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max
FROM raw JOIN days USING (fl_date) WHERE is_train_day AND {where}"""
        for c in ("dep_delay", "taxi_out", "arr_delay", "distance")
    ))


MODEL_COLUMNS = ("dep_delay", "taxi_out", "arr_delay", "distance")


@query("delay_describe", _describe_sql("TRUE"))
def delay_describe(spark, sf):
    return rounded(explore.describe(_train_days(spark, sf, *MODEL_COLUMNS), MODEL_COLUMNS), "mean", "stddev")


@query("delay_describe_clean", _describe_sql(
    "cancelled = '0.00' AND diverted = '0.00' AND dep_delay IS NOT NULL AND arr_delay IS NOT NULL"))
def delay_describe_clean(spark, sf):
    rows = _train_days(spark, sf, *MODEL_COLUMNS, "cancelled", "diverted").where(flown() & has_delays())
    return rounded(explore.describe(rows, MODEL_COLUMNS), "mean", "stddev")


@query("delay_ventiles", with_raw("""
SELECT (i - 1)::BIGINT AS position, q[i] AS value
FROM (SELECT quantile_disc(dep_delay, [k / 20.0 for k in range(21)]) AS q FROM raw), range(1, 22) AS r(i)"""
.replace("[k / 20.0 for k in range(21)]", "[" + ", ".join(str(k / 20) for k in range(21)) + "]")))
def delay_ventiles(spark, sf):
    out = explore.ventiles(sample.flights(spark, sf, "dep_delay"))
    return out.withColumn("position", F.col("position").cast("bigint"))


QUANTILE_SQL = """
SELECT dep_delay, quantile_disc(arr_delay, 70.0 / 101) AS arrival_delay, count(arr_delay) AS numflights
FROM {source} GROUP BY dep_delay HAVING count(arr_delay) > 370"""


@query("conditional_quantile", with_raw(QUANTILE_SQL.format(source="raw")))
def conditional_quantile(spark, sf):
    return explore.conditional_quantile(sample.flights(spark, sf, *DELAYS))


@query("conditional_quantile_sketch", with_raw(QUANTILE_SQL.format(source="raw")))
def conditional_quantile_sketch(spark, sf):
    return explore.conditional_quantile(sample.flights(spark, sf, *DELAYS), sketch=True)


@query("conditional_quantile_train", with_raw(QUANTILE_SQL.format(
    source="raw JOIN days USING (fl_date) WHERE is_train_day")))
def conditional_quantile_train(spark, sf):
    return explore.conditional_quantile(_train_days(spark, sf, *DELAYS))


@query("outlier_threshold_sweep", with_raw(f"""
SELECT t::BIGINT AS threshold,
  ((SELECT count(dep_delay) FROM raw) - sum(numflights))::BIGINT AS num_removed,
  round(avg(arrival_delay * numflights) / avg(dep_delay * numflights), 6) AS lm
FROM (SELECT unnest([5, 10, 22, 100, 200, 300, 370, 500, 1000]) AS t)
LEFT JOIN {BY_DELAY} d ON d.numflights > t GROUP BY t"""))
def outlier_threshold_sweep(spark, sf):
    sweep = explore.outlier_sweep(sample.flights(spark, sf, *DELAYS))
    return rounded(sweep, "lm").withColumn("threshold", F.col("threshold").cast("bigint"))


@query("likelihood_delay_30", with_raw(f"""
SELECT dep_delay, numflights, round(0.52 * stddev_arrival_delay + arrival_delay, 6) AS arr_delay_30
FROM {BY_DELAY} WHERE numflights > 370"""))
def likelihood_delay_30(spark, sf):
    table = explore.likelihood_delay(sample.flights(spark, sf, *DELAYS))
    return rounded(table, "arr_delay_30").select("dep_delay", "numflights", "arr_delay_30")


@query("decision_crossing", with_raw(f"""
SELECT 'normal' AS method, min(dep_delay) AS dep_delay FROM {BY_DELAY}
WHERE numflights > 370 AND 0.52 * stddev_arrival_delay + arrival_delay >= 15
UNION ALL
SELECT 'empirical', min(dep_delay) FROM ({QUANTILE_SQL.format(source="raw")}) WHERE arrival_delay >= 15"""))
def decision_crossing(spark, sf):
    flights = sample.flights(spark, sf, *DELAYS)
    normal = explore.crossing(explore.likelihood_delay(flights), "arr_delay_30")
    empirical = explore.crossing(explore.conditional_quantile(flights), "arrival_delay")
    return (
        normal.select(F.lit("normal").alias("method"), "dep_delay")
        .unionByName(empirical.select(F.lit("empirical").alias("method"), "dep_delay"))
    )


def _confusion_sql(limit: int, where: str = "TRUE") -> str:
    return f"""
SELECT count(*) FILTER (WHERE dep_delay < {limit} AND arr_delay < 15) AS correct_nocancel,
  count(*) FILTER (WHERE dep_delay < {limit} AND arr_delay >= 15) AS wrong_nocancel,
  count(*) FILTER (WHERE dep_delay >= {limit} AND arr_delay < 15) AS wrong_cancel,
  count(*) FILTER (WHERE dep_delay >= {limit} AND arr_delay >= 15) AS correct_cancel
FROM raw JOIN days USING (fl_date) WHERE {where}"""


@query("confusion_matrix", with_raw(_confusion_sql(15, "dest IS NOT NULL")))
def confusion_matrix(spark, sf):
    return explore.confusion_by_count(sample.flights(spark, sf, "dest", *DELAYS))


@query("decision_eval", with_raw(_confusion_sql(17, "NOT is_train_day")))
def decision_eval(spark, sf):
    return explore.confusion(_test_days(spark, sf, *DELAYS), dep_limit=17)


@query("decision_fractions", with_raw(f"""
SELECT *, round(correct_nocancel / (correct_nocancel + wrong_nocancel), 6) AS nocancel_fraction,
  round(correct_cancel / (correct_cancel + wrong_cancel), 6) AS cancel_fraction
FROM ({_confusion_sql(17, "NOT is_train_day")})"""))
def decision_fractions(spark, sf):
    tally = explore.confusion(_test_days(spark, sf, *DELAYS), dep_limit=17)
    return rounded(explore.decision_fractions(tally), "nocancel_fraction", "cancel_fraction")


@query("boundary_eval", with_raw("""
SELECT count(*) FILTER (WHERE dep_delay = 15 AND arr_delay < 15) AS correct_nocancel,
  count(*) FILTER (WHERE dep_delay = 15 AND arr_delay >= 15) AS wrong_nocancel,
  count(*) FILTER (WHERE dep_delay = 16 AND arr_delay < 15) AS wrong_cancel,
  count(*) FILTER (WHERE dep_delay = 16 AND arr_delay >= 15) AS correct_cancel
FROM raw JOIN days USING (fl_date) WHERE NOT is_train_day"""))
def boundary_eval(spark, sf):
    return explore.boundary_eval(_test_days(spark, sf, *DELAYS))


@query("short_haul_eval", with_raw("""
SELECT count(*) FILTER (WHERE dep_delay = 17 AND arr_delay < 17) AS wrong_cancel,
  count(*) FILTER (WHERE dep_delay = 17 AND arr_delay >= 17) AS correct_cancel
FROM raw JOIN days USING (fl_date) WHERE NOT is_train_day AND distance < 316"""))
def short_haul_eval(spark, sf):
    return explore.short_haul_eval(_test_days(spark, sf, *DELAYS, "distance"))


@query("banded_eval", with_raw("""
SELECT count(*) FILTER (WHERE dep_delay >=
    CASE WHEN distance < 493 AND distance >= 316 THEN 18 WHEN distance < 316 THEN 17
      WHEN distance < 731 THEN 18 ELSE 19 END) AS correct_cancel
FROM raw JOIN days USING (fl_date) WHERE NOT is_train_day AND arr_delay >= 15"""))
def banded_eval(spark, sf):
    return explore.banded_eval(_test_days(spark, sf, *DELAYS, "distance"))


@query("origin_average_delay", with_raw("""
SELECT origin, round(avg(dep_delay), 6) AS dep_delay, round(avg(arr_delay), 6) AS arr_delay
FROM raw GROUP BY origin"""))
def origin_average_delay(spark, sf):
    from tarmac.operators.delays import origin_average_delay as by_origin

    return rounded(by_origin(sample.flights(spark, sf, "origin", *DELAYS)), *DELAYS)


@query("delay_histogram", with_raw("""
SELECT dep_delay, count(arr_delay) AS numflights FROM raw WHERE dep_delay IS NOT NULL GROUP BY dep_delay"""))
def delay_histogram(spark, sf):
    return explore.delay_histogram(sample.flights(spark, sf, *DELAYS)).orderBy("dep_delay")


@query("arrival_distribution_by_flag", with_raw("""
SELECT (dep_delay < 10)::BIGINT AS ontime, count(arr_delay) AS n, min(arr_delay) AS min,
  quantile_disc(arr_delay, 0.25) AS q1, quantile_disc(arr_delay, 0.5) AS median,
  quantile_disc(arr_delay, 0.75) AS q3, max(arr_delay) AS max
FROM raw WHERE dep_delay IS NOT NULL GROUP BY 1"""))
def arrival_distribution_by_flag(spark, sf):
    spread = explore.arrival_spread(sample.flights(spark, sf, *DELAYS))
    return spread.withColumn("ontime", F.col("ontime").cast("bigint"))


@query("arrival_histogram_by_flag", with_raw("""
SELECT (dep_delay < 10)::BIGINT AS ontime, (floor(arr_delay / 5) * 5)::BIGINT AS bin, count(*) AS n
FROM raw WHERE dep_delay IS NOT NULL AND arr_delay IS NOT NULL GROUP BY 1, 2"""))
def arrival_histogram_by_flag(spark, sf):
    bins = explore.arrival_histogram(sample.flights(spark, sf, *DELAYS))
    return bins.withColumn("ontime", F.col("ontime").cast("bigint"))


@query("distance_delay_hist2d", with_raw("""
SELECT floor(distance * 20 / 2000)::BIGINT AS distance_cell,
  floor((dep_delay + 20) * 20 / 50)::BIGINT AS dep_delay_cell, count(*) AS n
FROM raw WHERE distance > 0 AND distance < 2000 AND dep_delay > -20 AND dep_delay < 30 GROUP BY 1, 2"""))
def distance_delay_hist2d(spark, sf):
    flights = sample.flights(spark, sf, "distance", "dep_delay")
    return explore.histogram_2d(flights, ("distance", 0, 2000), ("dep_delay", -20, 30))


def _bin_sql(column: str, edges: list[int]) -> str:
    return f"CASE WHEN {column} IS NOT NULL THEN len(list_filter({edges}, lambda e: e <= {column})) END"


BINS_SQL = f"""
SELECT {_bin_sql('distance', [214, 316, 394, 493, 596, 731, 868, 1020, 1269])} AS distbin, {_bin_sql('dep_delay', [-8, -6, -4, -3, -2, 0, 2, 6, 13])} AS depdelaybin,
  (arr_delay < 15)::BIGINT::DOUBLE AS ontime FROM raw"""


@query("bayes_ontime_table", with_raw(f"""
SELECT distbin::BIGINT AS dist, depdelaybin::BIGINT AS delay, round(avg(ontime), 6) AS ontime
FROM ({BINS_SQL}) GROUP BY 1, 2"""))
def bayes_ontime_table(spark, sf):
    table = bayes.ontime_table(sample.flights(spark, sf, "distance", *DELAYS))
    return rounded(table, "ontime").select(
        F.col("dist").cast("bigint").alias("dist"), F.col("delay").cast("bigint").alias("delay"), "ontime"
    )


@query("bayes_bins", with_raw(f"""
SELECT distbin::BIGINT AS distbin, depdelaybin::BIGINT AS depdelaybin, ontime, count(*) AS n
FROM ({BINS_SQL}) GROUP BY ALL"""))
def bayes_bins(spark, sf):
    bins = bayes.with_bins(sample.flights(spark, sf, "distance", *DELAYS))
    return bins.groupBy(
        F.col("distbin").cast("bigint").alias("distbin"),
        F.col("depdelaybin").cast("bigint").alias("depdelaybin"), "ontime",
    ).agg(F.count(F.lit(1)).alias("n"))


@query("sample_bernoulli")
def sample_bernoulli(spark, sf):
    flights = sample.flights(spark, sf, "flight_key", *DELAYS)
    return sampling.bernoulli(flights.where(F.col("dep_delay") > 10), 0.01, seed=13)


@query("sample_by_key", with_raw("""
SELECT flight_key, dep_delay, arr_delay FROM raw
WHERE ('0x' || substr(md5(flight_key), 1, 8))::UBIGINT / 4294967296.0 < 0.01"""))
def sample_by_key(spark, sf):
    return sampling.by_key(sample.flights(spark, sf, "flight_key", *DELAYS), 0.01, "flight_key")


@query("range_filter", with_raw("""
SELECT flight_key, distance, dep_delay FROM raw
WHERE dep_delay > -20 AND dep_delay < 30 AND distance < 2000"""))
def range_filter(spark, sf):
    rows = sample.flights(spark, sf, "flight_key", "distance", "dep_delay")
    return rows.where("dep_delay > -20 AND dep_delay < 30 AND distance < 2000")


@query("valid_delays", with_raw("""
SELECT flight_key, dep_delay, arr_delay FROM raw WHERE dep_delay IS NOT NULL AND arr_delay IS NOT NULL"""))
def valid_delays(spark, sf):
    return sample.flights(spark, sf, "flight_key", *DELAYS).where(has_delays())


@query("flown_flights", with_raw("""
SELECT flight_key, dep_delay, arr_delay FROM raw WHERE cancelled = '0.00' AND diverted = '0.00'"""))
def flown_flights(spark, sf):
    rows = sample.flights(spark, sf, "flight_key", *DELAYS, "cancelled", "diverted")
    return rows.where(flown()).select("flight_key", *DELAYS)


@query("row_slice", with_raw("""
SELECT * FROM (SELECT dep_delay, numflights, row_number() OVER (ORDER BY dep_delay) - 1 AS row_no
  FROM (SELECT dep_delay, count(arr_delay) AS numflights FROM raw GROUP BY dep_delay) WHERE numflights > 370)
WHERE row_no >= 20 AND row_no < 40"""))
def row_slice(spark, sf):
    table = explore.frequent_delays(sample.flights(spark, sf, *DELAYS)).select("dep_delay", "numflights")
    out = sampling.row_slice(table, ["dep_delay"], 20, 40)
    return out.withColumn("row_no", F.col("row_no").cast("bigint"))


@query("train_days_join", with_raw("""
SELECT flight_key, dep_delay, taxi_out, arr_delay, distance FROM raw JOIN days USING (fl_date)
WHERE is_train_day"""))
def train_days_join(spark, sf):
    return _train_days(spark, sf, "flight_key", *MODEL_COLUMNS).select("flight_key", *MODEL_COLUMNS)


@query("holdout_split", with_raw("""
SELECT holdout::BIGINT AS holdout, count(*) AS n, sum(arr_delay) AS total FROM raw JOIN (
  SELECT *, ('0x' || substr(md5(fl_date::VARCHAR), 1, 8))::UBIGINT / 4294967296.0 < 0.2 AS holdout FROM days)
USING (fl_date) WHERE is_train_day GROUP BY 1"""))
def holdout_split(spark, sf):
    days = sampling.with_holdout(sample.train_days(spark), seed=None)
    rows = join_days(sample.flights(spark, sf, "fl_date", "arr_delay"), days, True)
    return rows.groupBy(F.col("holdout").cast("bigint").alias("holdout")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("arr_delay").alias("total")
    )


@query("holdout_split_random")
def holdout_split_random(spark, sf):
    days = sampling.with_holdout(sample.train_days(spark), seed=13)
    rows = join_days(sample.flights(spark, sf, "fl_date", "arr_delay"), days, True)
    return rows.groupBy("holdout").agg(F.count(F.lit(1)).alias("n"))


@query("scaled_features", with_raw("""
SELECT flight_key, round(dep_delay / 30, 6) AS dep_delay, round(taxi_out / 10 - 1, 6) AS taxi_out,
  round(distance / 1000 - 1, 6) AS distance FROM raw"""))
def scaled_features(spark, sf):
    rows = sample.flights(spark, sf, "flight_key", "dep_delay", "taxi_out", "distance")
    return rounded(rows.withColumns(scaled()), "dep_delay", "taxi_out", "distance")
