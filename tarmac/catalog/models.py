"""Features, fitted models, scoring and prediction outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac.catalog.checksql import text, with_averages, with_events, with_raw
from tarmac.catalog.flightlog import PAYLOAD_SQL, SUCCESS_SQL
from tarmac.catalog.registry import checksum, checksum_sql, query, rounded
from tarmac.functions import predicates as P
from tarmac.models import evaluate, features, logistic, network, newton, scoring
from tarmac.operators import sampling, training
from tarmac.operators.events import flight_events
from tarmac.operators.lookups import join_days
from tarmac.plans import scoring as scoring_plan, studies
from tarmac.session import measured, scratch
from tarmac.sinks import cells, models as model_sink, tables
from tarmac.sources import sample

BASE = ("dep_delay", "taxi_out", "arr_delay", "distance")


def _flights(spark, sf, days: DataFrame, train: bool) -> DataFrame:
    rows = sample.flights(spark, sf, "fl_date", *BASE, "cancelled", "diverted")
    return join_days(rows.where(P.flown() & P.has_delays()), days, train).select("holdout", *BASE)


def _parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Flights of the training days, the held-out ones marked and stored once, and test flights."""
    days = sampling.with_holdout(sample.train_days(spark), seed=None)
    train = measured(_flights(spark, sf, days, True), "model-train")
    return train, _flights(spark, sf, days, False)


def _model(spark, sf):
    train, test = _parts(spark, sf)
    return logistic.fit(train), test


@query("logistic_eval")
def logistic_eval(spark, sf):
    model, test = _model(spark, sf)
    return evaluate.probabilistic(logistic.evaluated(model, test))


@query("logistic_categorical_eval")
def logistic_categorical_eval(spark, sf):
    model, test = _model(spark, sf)
    return evaluate.categorical(logistic.evaluated(model, test))


@query("logistic_band_eval")
def logistic_band_eval(spark, sf):
    model, test = _model(spark, sf)
    return evaluate.near_threshold(logistic.evaluated(model, test))


@query("logistic_saved_model_eval")
def logistic_saved_model_eval(spark, sf):
    """The model is stored, loaded again and then used."""
    model, test = _model(spark, sf)
    path = scratch(spark, "model")
    model_sink.save_model(model, path)
    return evaluate.probabilistic(logistic.evaluated(model_sink.load_model(path), test))


@query("logistic_scaled_eval")
def logistic_scaled_eval(spark, sf):
    from tarmac.functions.features import scaled

    train, test = _parts(spark, sf)
    model = logistic.fit(train.withColumns(scaled()))
    return evaluate.probabilistic(logistic.evaluated(model, test.withColumns(scaled())))


@query("probability_sweep")
def probability_sweep(spark, sf):
    model, _ = _model(spark, sf)
    return logistic.sweep(model, spark)


@query("feature_ablation")
def feature_ablation(spark, sf):
    train, _ = _parts(spark, sf)
    return logistic.ablation(train.where("NOT holdout"), train.where("holdout"))


INPUTS = ("dep_delay", "taxi_out", "distance")
#: At the maximum of the likelihood, fitted and observed labels agree in the mean of each input that the fit has.
FITTED_SQL = """, train AS (
  SELECT dep_delay, taxi_out, distance, (arr_delay < 15)::BIGINT::DOUBLE AS label
  FROM raw JOIN (SELECT *, ('0x' || substr(md5(fl_date::VARCHAR), 1, 8))::UBIGINT / 4294967296.0 < 0.2 AS holdout FROM days) USING (fl_date)
  WHERE is_train_day AND cancelled = '0.00' AND diverted = '0.00' AND dep_delay IS NOT NULL AND arr_delay IS NOT NULL AND {where}
), means AS (
  SELECT count(*) AS n, avg(label) AS constant, avg(label * dep_delay) AS dep_delay, avg(label * taxi_out) AS taxi_out, avg(label * distance) AS distance FROM train
), inputs AS (UNPIVOT means ON constant, dep_delay, taxi_out, distance INTO NAME input VALUE m)
"""
TRAIN_SQL = FITTED_SQL.format(where="NOT holdout"), FITTED_SQL.format(where="TRUE")


def _fitted_means(scored: DataFrame, tolerance: float, *by: str) -> DataFrame:
    """Per input: the observed mean, and whether the fitted one is as near to it as `tolerance` of the mean size of the input."""
    x = {"constant": F.lit(1.0), **{f: F.col(f) for f in INPUTS}}
    shape = lambda v: F.struct(
        F.avg(F.col("label") * v).alias("m"), F.avg(F.col("probability") * v).alias("p"), F.avg(F.abs(v)).alias("size"))
    one = scored.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[shape(v).alias(f) for f, v in x.items()])
    long = one.unpivot([*by, "n"], list(x), "input", "s")
    return long.select(*by, "input", "n", F.round("s.m", 6).alias("label_mean"), (F.abs(F.col("s.p") - F.col("s.m")) <= tolerance * F.col("s.size")).alias("fitted"))


@query("logistic_fitted_means", with_raw("").rstrip() + f"""{TRAIN_SQL[1]}
SELECT input, n, round(m, 6) AS label_mean, TRUE AS fitted FROM inputs""")
def logistic_fitted_means(spark, sf):
    train, _ = _parts(spark, sf)
    return _fitted_means(logistic.evaluated_rows(logistic.fit(train, INPUTS), train), 1e-3)


@query("ablation_fitted_means", with_raw("").rstrip() + f"""{TRAIN_SQL[0]}
SELECT dropped, input, n, round(m, 6) AS label_mean, TRUE AS fitted
FROM inputs, (SELECT unnest(['none', 'dep_delay', 'taxi_out', 'distance']) AS dropped) WHERE dropped <> input""")
def ablation_fitted_means(spark, sf):
    """Fits on all inputs and without each, made by common Newton steps."""
    train, _ = _parts(spark, sf)
    rows = logistic.labelled(train.where("NOT holdout"))
    dropped = ["none", *INPUTS]
    fits = newton.fit_all(rows, [[f for f in INPUTS if f != d] for d in dropped])
    name = F.array(*map(F.lit, dropped))[F.col("fit")]
    return _fitted_means(newton.scored(rows, fits).withColumn("dropped", name), 1e-8, "dropped").where("dropped <> input")


FORMULA_SQL = "greatest(0, least(1, 0.5 - dep_delay / 100))"


def _formula_probability():
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.5 - F.col("dep_delay") / 100))


def _formula_scored(spark, sf) -> DataFrame:
    """Events with a forecast anyone can recompute; every eighth part number has none."""
    events = sample.event_log(spark, sf)
    skipped = F.col("op_carrier_fl_num").cast("bigint") % 8 == 0
    return events.withColumn("probability", F.when(~skipped & F.col("dep_delay").isNotNull(), _formula_probability()))


DECISION_SQL = f"""
decided AS (
  SELECT * EXCLUDE (probability), CASE WHEN probability IS NULL THEN -5.0
    WHEN cancelled = '0.00' AND coalesce(diverted, '') = '0.00' AND event = 'arrived'
      THEN (arr_delay < 15)::INTEGER::DOUBLE
    ELSE probability END AS ontime
  FROM (SELECT *, CASE WHEN op_carrier_fl_num::BIGINT % 8 <> 0 AND dep_delay IS NOT NULL
      THEN {FORMULA_SQL} END AS probability FROM events_log))"""


def with_decisions(select: str) -> str:
    return f"{with_events('').rstrip()},{DECISION_SQL} {select}"


@query("probability_band", with_events(f"""
SELECT event, count(*) AS n, sum(dep_delay) AS total FROM events_log
WHERE dep_delay IS NOT NULL AND op_carrier_fl_num::BIGINT % 8 <> 0
  AND {FORMULA_SQL} > 0.65 AND {FORMULA_SQL} < 0.75 GROUP BY event"""))
def probability_band(spark, sf):
    rows = _formula_scored(spark, sf).where(P.probability_band())
    return rows.groupBy("event").agg(F.count(F.lit(1)).alias("n"), F.sum("dep_delay").alias("total"))


@query("ontime_decision", with_decisions(f"""
SELECT op_carrier_fl_num, event, {text('notify_time')} AS notify_time, round(ontime, 6) AS ontime FROM decided"""))
def ontime_decision(spark, sf):
    from tarmac.functions.times import time_text

    rows = scoring.decide(_formula_scored(spark, sf))
    return rounded(rows.select("op_carrier_fl_num", "event", time_text("notify_time").alias("notify_time"), "ontime"), "ontime")


@query("prediction_csv", with_decisions(f"""
SELECT event, count(*) AS n, sum(length(line))::BIGINT AS n_chars, {checksum_sql('line')} AS hash
FROM (SELECT event, {PAYLOAD_SQL} || ',' || CASE WHEN ontime >= 0 THEN round(ontime, 2)::DECIMAL(20, 2)::VARCHAR
    ELSE '' END AS line FROM decided) GROUP BY event"""))
def prediction_csv(spark, sf):
    lines = tables.prediction_lines(scoring.decide(_formula_scored(spark, sf)))
    event = F.when(F.col("value").contains(",departed,"), "departed").otherwise("arrived")
    return lines.groupBy(event.alias("event")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("n_chars"),
        checksum("value").alias("hash"),
    )


@query("prediction_rows", with_decisions("""
SELECT event, origin_airport_seq_id::BIGINT AS origin_airport_seq_id, count(*) AS n, count(arr_delay) AS n_arr,
  round(sum(ontime), 4) AS ontime FROM decided GROUP BY 1, 2"""))
def prediction_rows(spark, sf):
    rows = tables.prediction_rows(scoring.decide(_formula_scored(spark, sf)))
    return rows.groupBy("event", "origin_airport_seq_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("arr_delay").alias("n_arr"),
        F.round(F.sum("ontime"), 4).alias("ontime"),
    )


_KEY_SQL = (
    "origin || '#' || dest || '#' || op_carrier || '#' || "
    "(9223372036854775807 - epoch_ms(crs_dep_time))::VARCHAR"
)


def _cells_sql() -> str:
    from tarmac import schemas

    decimals = {"dep_delay": 2, "taxi_out": 2, "taxi_in": 2, "arr_delay": 2, "distance": 2,
                "dep_airport_lat": 8, "dep_airport_lon": 8, "dep_airport_tzoffset": 1,
                "arr_airport_lat": 8, "arr_airport_lon": 8, "arr_airport_tzoffset": 1}
    parts = []
    for n, k in schemas.EVENT_ROW_COLUMNS:
        value = f"{n}::DECIMAL(20,{decimals[n]})::VARCHAR" if n in decimals else (
            text(n) if k == "timestamp" else f"{n}::VARCHAR")
        parts.append((n.upper(), value))
    parts.append(("ONTIME", "CASE WHEN ontime >= 0 THEN round(ontime, 2)::DECIMAL(20, 2)::VARCHAR END"))
    return " UNION ALL ".join(
        f"SELECT {_KEY_SQL} AS row_key, '{n}' AS qualifier, {v} AS value, epoch_us(notify_time) AS ts FROM decided"
        for n, v in parts
    )


@query("prediction_cells", with_decisions(f"""
SELECT qualifier, count(*) AS n, {checksum_sql("row_key || '/' || value")} AS hash, max(ts) AS latest
FROM ({_cells_sql()}) WHERE value IS NOT NULL GROUP BY qualifier"""))
def prediction_cells(spark, sf):
    rows = cells.prediction_cells(scoring.decide(_formula_scored(spark, sf)))
    return rows.groupBy("qualifier").agg(
        F.count(F.lit(1)).alias("n"), checksum(F.concat_ws("/", "row_key", "value")).alias("hash"),
        F.max("ts_micros").alias("latest"),
    )


def _featured(spark, sf) -> DataFrame:
    events = sample.stored_events(spark, sf, "op_carrier_fl_num", *training.EVENT_COLUMNS)
    return training.with_averages(events, training.departure_averages(events, sample.train_days(spark)))


@query("prediction_payload", with_averages("""
SELECT origin, dest, count(*) AS n, sum(dep_delay) AS dep_delay, 0.0::DOUBLE AS taxiout, sum(distance) AS distance
FROM featured WHERE dep_delay IS NOT NULL GROUP BY origin, dest"""))
def prediction_payload(spark, sf):
    """JSON payloads of all good events, parsed back and summed."""
    schema = "array<struct<dep_delay double, taxiout double, distance double, carrier string, origin string, dest string>>"
    rows = _featured(spark, sf).where("dep_delay IS NOT NULL").select(scoring.payload().alias("json"))
    one = rows.select(F.from_json("json", schema)[0].alias("i")).select("i.*")
    return one.groupBy("origin", "dest").agg(
        F.count(F.lit(1)).alias("n"), F.sum("dep_delay").alias("dep_delay"),
        F.sum("taxiout").alias("taxiout"), F.sum("distance").alias("distance"),
    )


def _training_parts(spark, featured: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training rows of the training days and of the others, read from one stored table."""
    labeled = featured.join(sample.train_days(spark), "fl_date")
    rows = measured(training.training_rows(labeled, keep=("is_train_day",)), "training-rows")
    return tuple(rows.where(c).drop("is_train_day") for c in ("is_train_day", "NOT is_train_day"))


@query("linear_columns_eval")
def linear_columns_eval(spark, sf):
    train, test = _training_parts(spark, _featured(spark, sf))
    model = logistic.fit_columns(train, features.AIRPORT_BUCKETS)
    scored = logistic.predict(model, features.with_hashed(test))
    return evaluate.probabilistic(scored)


@query("network_eval")
def network_eval(spark, sf):
    train, test = _training_parts(spark, _featured(spark, sf))
    model = network.fit(train)
    return evaluate.probabilistic(network.predict(model, test))


@query("tuning_grid")
def tuning_grid(spark, sf):
    """All fifteen settings of the search, each fitted on every training row."""
    train, test = _training_parts(spark, _featured(spark, sf))
    return network.search(train, test, network.trial_settings())


@query("scored_flights")
def scored_flights(spark, sf):
    featured = measured(_featured(spark, sf), "featured")
    train, _ = _training_parts(spark, featured)
    model = logistic.fit_columns(train, features.AIRPORT_BUCKETS)
    ready, _ = scoring.scorable(featured)
    decided = scoring.decide(scoring.score(model, ready, features.AIRPORT_BUCKETS))
    return decided.select("op_carrier_fl_num", "origin", "dest", "event", "ontime")


EVALUATED_SQL = f"""
forecasts AS (SELECT {FORMULA_SQL} AS p, (arr_delay < 15)::BIGINT AS label FROM raw
  WHERE dep_delay IS NOT NULL AND arr_delay IS NOT NULL)"""


def _evaluated_sql(keep: str, where: str = "TRUE") -> str:
    return with_raw("").rstrip() + f""",{EVALUATED_SQL}
SELECT count_if(NOT keep)::BIGINT AS total_cancel,
  round(count_if(NOT keep AND label = 0) / nullif(count_if(NOT keep), 0), 6) AS correct_cancel,
  count_if(keep)::BIGINT AS total_nocancel,
  round(count_if(keep AND label = 1) / nullif(count_if(keep), 0), 6) AS correct_nocancel,
  round(count_if(keep = (label = 1)) / nullif(count(*), 0), 6) AS accuracy,
  round(sqrt(avg((label - p) * (label - p))), 6) AS rmse
FROM (SELECT *, {keep} AS keep FROM forecasts WHERE {where})"""


def _forecasts(spark, sf) -> DataFrame:
    """Landed flights with the recomputable forecast and their label."""
    rows = sample.flights(spark, sf, "dep_delay", "arr_delay").where(P.has_delays())
    return rows.select(
        _formula_probability().alias("probability"), (F.col("arr_delay") < 15).cast("double").alias("label"))


def _rounded_shares(report: DataFrame) -> DataFrame:
    return rounded(report, *[c for c in report.columns if not c.startswith("total")])


@query("forecast_eval", _evaluated_sql("p >= 0.7"))
def forecast_eval(spark, sf):
    return _rounded_shares(evaluate.probabilistic(_forecasts(spark, sf)))


@query("forecast_band_eval", _evaluated_sql("p >= 0.7", "p > 0.65 AND p < 0.75"))
def forecast_band_eval(spark, sf):
    return _rounded_shares(evaluate.near_threshold(_forecasts(spark, sf)))


@query("forecast_categorical_eval", f"SELECT * EXCLUDE (accuracy, rmse) FROM ({_evaluated_sql('p >= 0.5')})")
def forecast_categorical_eval(spark, sf):
    rows = _forecasts(spark, sf).withColumn("prediction", (F.col("probability") >= 0.5).cast("double"))
    return _rounded_shares(evaluate.categorical(rows))


@query("unscorable_flights", with_averages("""
SELECT event, cancelled, count(*) AS n FROM featured WHERE dep_delay IS NULL OR op_carrier_fl_num::BIGINT % 7 = 0 GROUP BY 1, 2"""))
def unscorable_flights(spark, sf):
    """Every seventh flight number reports no departure delay."""
    known = F.when(F.col("op_carrier_fl_num").cast("bigint") % 7 != 0, F.col("dep_delay"))
    _, rest = scoring.scorable(_featured(spark, sf).withColumn("dep_delay", known))
    return rest.groupBy("event", "cancelled").agg(F.count(F.lit(1)).alias("n"))


VOCABULARY_SQL = "['AS', 'VX', 'F9', 'UA', 'US', 'WN', 'HA', 'EV', 'MQ', 'DL', '00', '86', 'NK', 'AA']"


@query("vocabulary_features", with_raw(f"""
SELECT op_unique_carrier AS carrier, coalesce(list_position({VOCABULARY_SQL}, op_unique_carrier) - 1, 14)::DOUBLE AS carrier_ix,
  (op_unique_carrier IN (SELECT unnest({VOCABULARY_SQL})))::BIGINT AS n_hot, count(*) AS n
FROM raw GROUP BY 1"""))
def vocabulary_features(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = sample.flights(spark, sf, "op_unique_carrier").withColumnRenamed("op_unique_carrier", "carrier")
    stages = features.column_stages()[:2]
    out = Pipeline(stages=stages).fit(rows).transform(rows)
    hot = F.aggregate(vector_to_array("carrier_hot"), F.lit(0.0), lambda a, x: a + x)
    return out.groupBy("carrier", "carrier_ix", hot.cast("bigint").alias("n_hot")).agg(F.count(F.lit(1)).alias("n"))


def _bucket_sql(column: str, low: float, high: float, n: int) -> str:
    cuts = [low + (high - low) * i / (n - 1) for i in range(n)]
    return f"len(list_filter({cuts}, lambda e: e <= {column}))::DOUBLE"


@query("bucket_cross_features", with_averages(f"""
SELECT origin, dest, {_bucket_sql('dep_airport_lat', 20, 50, 5)} AS d_dep_lat,
  {_bucket_sql('dep_airport_lon', -120, -70, 5)} AS d_dep_lon, {_bucket_sql('arr_airport_lat', 20, 50, 5)} AS d_arr_lat,
  {_bucket_sql('arr_airport_lon', -120, -70, 5)} AS d_arr_lon, count(*) AS n
FROM featured WHERE arr_delay IS NOT NULL GROUP BY ALL"""))
def bucket_cross_features(spark, sf):
    rows = training.training_rows(sample.event_log(spark, sf).where(P.good_event()))
    for stage in features.location_buckets(5):
        rows = stage.transform(rows)
    buckets = ["d_dep_lat", "d_dep_lon", "d_arr_lat", "d_arr_lon"]
    return rows.groupBy("origin", "dest", *buckets).agg(F.count(F.lit(1)).alias("n"))


@query("hashed_features")
def hashed_features(spark, sf):
    rows = training.training_rows(sample.event_log(spark, sf).where(P.good_event()))
    hashed = features.with_hashed(rows, features.AIRPORT_BUCKETS, 5)
    return hashed.groupBy("origin", "origin_ix", "dep_loc", "arr_loc", "dep_arr").agg(F.count(F.lit(1)).alias("n"))


# --- jobs with models -----------------------------------------------------------

@query("scored_to_sinks", with_averages(f"""
SELECT event, count(*) AS n_events, count(*) FILTER ({SUCCESS_SQL}) AS n_lines, count(*) FILTER ({SUCCESS_SQL}) AS n_table,
  count(*) FILTER ({SUCCESS_SQL}) AS n_cells, count(*) FILTER (NOT coalesce({SUCCESS_SQL}, false)) AS n_rejected, 0::BIGINT AS n_unscored,
  count(*) FILTER ({SUCCESS_SQL} AND event = 'arrived' AND arr_delay < 15) AS n_ontime, 0::BIGINT AS n_impossible
FROM events_log GROUP BY event"""))
def scored_to_sinks(spark, sf):
    """The scoring job: every event is scored into lines, table and cells, or rejected, or unscored."""
    out = scratch(spark, "scored")
    # Stored as flights: both events of one share nearly all of their fields.
    events = flight_events(measured(sample.corrected(spark, sf), "scored-flights", packed=True))
    days = sample.train_days(spark)
    averages = measured(training.departure_averages(events, days), "scored-averages")
    train, _ = _training_parts(spark, training.with_averages(events, averages))
    scoring_plan.score_and_store(events, averages, logistic.fit_columns(train, 64, max_iter=10), 64, out)
    table = spark.read.parquet(f"{out}/table")
    landed = F.when(F.col("event") == "arrived", F.col("ontime"))
    fair = F.when(F.col("event") == "arrived", F.col("ontime").isin(0.0, 1.0)).otherwise(F.col("ontime").between(0, 1))
    parts = {
        "n_events": events.groupBy("event").agg(F.count(F.lit(1)).alias("n_events")),
        "n_lines": spark.read.text(f"{out}/lines").groupBy(F.regexp_extract("value", "(departed|arrived)", 1).alias("event")).agg(F.count(F.lit(1)).alias("n_lines")),
        "n_table": table.groupBy("event").agg(
            F.count(F.lit(1)).alias("n_table"), F.count_if(landed == 1).alias("n_ontime"), F.count_if(~fair).alias("n_impossible")),
        "n_cells": spark.read.parquet(f"{out}/cells").where("qualifier = 'EVENT'").groupBy(F.col("value").alias("event")).agg(F.count(F.lit(1)).alias("n_cells")),
        "n_rejected": spark.read.parquet(f"{out}/rejected").groupBy("event").agg(F.count(F.lit(1)).alias("n_rejected")),
        "n_unscored": spark.read.parquet(f"{out}/unscored").groupBy("event").agg(F.count(F.lit(1)).alias("n_unscored")),
    }
    whole = parts.pop("n_events")
    for part in parts.values():
        whole = whole.join(part, "event", "left")
    return whole.fillna(0)


@query("trained_and_saved", with_averages("""
SELECT count(*) AS n_test, true AS same_after_loading, true AS better_than_base_rate
FROM training JOIN days USING (fl_date) WHERE NOT is_train_day"""))
def trained_and_saved(spark, sf):
    """The training job on all columns: the stored model gives the reported error again."""
    out = scratch(spark, "trained")
    train, test = _training_parts(spark, _featured(spark, sf))
    report = studies.train_classifier(train, test, out)
    again = evaluate.probabilistic(logistic.predict(model_sink.load_model(out), features.with_hashed(test)))
    base = test.agg(F.stddev_pop("ontime")).first()[0]
    return report.select(
        (F.col("total_cancel") + F.col("total_nocancel")).alias("n_test"),
        (F.abs(F.col("rmse") - F.lit(again.first()["rmse"])) < 1e-12).alias("same_after_loading"), (F.col("rmse") < F.lit(base)).alias("better_than_base_rate"))


@query("regression_experiment", with_raw("""
SELECT part, n FROM (SELECT count(*) FILTER (is_train_day) AS clean, count(*) FILTER (NOT is_train_day) AS categorical,
    count(*) FILTER (NOT is_train_day) AS probabilistic, count(*) FILTER (NOT is_train_day) AS scaled, 4::BIGINT AS ablation, 279::BIGINT AS sweep
  FROM raw JOIN days USING (fl_date) WHERE cancelled = '0.00' AND diverted = '0.00' AND dep_delay IS NOT NULL AND arr_delay IS NOT NULL)
UNPIVOT (n FOR part IN (clean, categorical, probabilistic, scaled, ablation, sweep))"""))
def regression_experiment(spark, sf):
    """The whole experiment; the rows that each part is about."""
    flights = sample.flights(spark, sf, "fl_date", *BASE, "cancelled", "diverted")
    _, found = studies.regression_experiment(flights, sample.train_days(spark), holdout_seed=None)
    out = None
    for part in ("clean", "categorical", "probabilistic", "scaled", "ablation", "sweep"):
        of = F.max("n") if part == "clean" else F.sum(F.col("total_cancel") + F.col("total_nocancel")) if part in ("categorical", "probabilistic", "scaled") else F.count(F.lit(1))
        row = found[part].agg(of.alias("n")).select(F.lit(part).alias("part"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query("exploratory_report", with_raw("""
SELECT name, n FROM (SELECT count(*) AS counts, 21::BIGINT AS ventiles, count(DISTINCT dep_delay) AS delay_histogram,
    9::BIGINT AS outlier_sweep, (SELECT count(*) FROM (SELECT 1 FROM raw GROUP BY dep_delay HAVING count(arr_delay) > 370)) AS conditional_quantile,
    (SELECT count(*) FROM (SELECT 1 FROM raw JOIN days USING (fl_date) WHERE is_train_day GROUP BY dep_delay HAVING count(arr_delay) > 370)) AS conditional_quantile_train
  FROM raw)
UNPIVOT (n FOR name IN (counts, ventiles, delay_histogram, outlier_sweep, conditional_quantile, conditional_quantile_train))"""))
def exploratory_report(spark, sf):
    """The report stored as files and read again: flights counted, and rows of its tables."""
    out = scratch(spark, "report")
    columns = ["fl_date", "dest", *BASE, "cancelled", "diverted"]
    report = studies.exploration(measured(sample.flights(spark, sf, *columns), "report-flights"), sample.train_days(spark))
    found = None
    for name, df in report.items():
        df.write.parquet(f"{out}/{name}")
        back = spark.read.parquet(f"{out}/{name}")
        if name in ("counts", "ventiles", "delay_histogram", "outlier_sweep", "conditional_quantile", "conditional_quantile_train"):
            row = back.agg((F.max("n_rows") if name == "counts" else F.count(F.lit(1))).alias("n")).select(F.lit(name).alias("name"), "n")
            found = row if found is None else found.unionByName(row)
    return found
