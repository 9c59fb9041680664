"""Composite jobs from end to end on the test tables."""

import pytest
from pyspark.sql import functions as F

from fixtures import R1, R2, R3, R4
from tarmac.functions.text import csv_line
from tarmac.operators import training
from tarmac.plans import datasets, ingest, scoring as scoring_plan, studies
from tarmac.models import logistic
from tarmac.session import measured
from tarmac.sources import files, sample, tables
from tarmac import schemas


@pytest.fixture(scope="module")
def log(spark, sf_dir):
    return measured(sample.event_log(spark, sf_dir), "test-log")


@pytest.fixture(scope="module")
def days(spark):
    return sample.train_days(spark)


def test_airport_filter(spark, tmp_path):
    ingest.filter_airport(tables.lines(spark, [R1, R2]), "SEA", str(tmp_path / "o"))
    assert spark.read.text(str(tmp_path / "o")).count() == 1


def test_line_jobs(spark, tmp_path):
    lines = tables.lines(spark, [R1, R2, R3, R4])
    datasets.strict_training_csv(lines, str(tmp_path / "train"))
    assert files.read_training_rows(spark, str(tmp_path / "train")).count() == 2
    datasets.hourly_averages(lines, str(tmp_path / "delays"))
    got = {tuple(r) for r in files.read_delay_lookup(spark, str(tmp_path / "delays")).collect()}
    assert got == {("PHX", "06", 29.0), ("SEA", "20", 20.0)}
    rows = {r["origin"]: r["avg_dep_delay"] for r in datasets.departure_features(lines).collect()}
    assert rows == {"PHX": 29.0, "SEA": 20.0}
    day = spark.createDataFrame([("2019-05-14", True)], "d string, is_train_day boolean").select(
        F.to_date("d").alias("fl_date"), "is_train_day")
    assert datasets.training_day_events(lines, day).count() == 3


def test_one_day(spark, tmp_path, log):
    datasets.day_to_training(log, "2018-02-05", str(tmp_path))
    n = log.where("fl_date = '2018-02-05' AND event = 'arrived' AND diverted = '0.00' AND arr_delay IS NOT NULL").count()
    assert files.read_training_rows(spark, f"{tmp_path}/train").count() == n > 0


@pytest.mark.parametrize("per_window, factor", [(False, 1), (True, 12)])
def test_full_features(spark, tmp_path, log, days, per_window, factor):
    datasets.full_features(log, days, str(tmp_path / "f"), per_window=per_window)
    train = days.where("is_train_day")
    n = log.join(train, "fl_date", "left_semi").where("event = 'arrived' AND arr_delay IS NOT NULL").count()
    assert spark.read.csv(str(tmp_path / "f")).count() == factor * n


def test_train_and_test_are_disjoint_and_whole(spark, tmp_path, log, days):
    datasets.train_and_test(log, days, str(tmp_path))
    train = files.read_training_rows(spark, f"{tmp_path}/train").count()
    test = files.read_training_rows(spark, f"{tmp_path}/test").count()
    assert train > 0 and test > 0
    assert train + test == log.where("event = 'arrived' AND arr_delay IS NOT NULL").count()
    datasets.train_and_test(log, days, str(tmp_path / "small"), cutoff="2018-02-04")
    small = files.read_training_rows(spark, f"{tmp_path}/small/train").count()
    assert 0 < small < train


def test_score_and_store(spark, tmp_path, log, days):
    averages = training.departure_averages(log, days)
    rows = measured(training.training_rows(training.with_averages(log, averages)), "rows")
    model = logistic.fit_columns(rows, 16, max_iter=10)
    decided = scoring_plan.score_and_store(log, averages, model, 16, str(tmp_path))
    n = decided.count()
    table = spark.read.parquet(f"{tmp_path}/table")
    assert [f.name for f in table.schema] == [n for n, _ in schemas.PREDICTION_COLUMNS]
    assert table.count() == spark.read.text(f"{tmp_path}/lines").count() == n > 0
    rejected = spark.read.parquet(f"{tmp_path}/rejected").count()
    unscored = spark.read.parquet(f"{tmp_path}/unscored").count()
    assert n + rejected + unscored == log.count()
    assert decided.where("event = 'arrived' AND ontime NOT IN (0, 1)").count() == 0
    assert decided.where("event = 'departed' AND (ontime < 0 OR ontime > 1)").count() == 0
    ordered = spark.read.parquet(f"{tmp_path}/cells")
    assert ordered.where("qualifier = 'ONTIME'").count() == n


def test_studies(spark, sf_dir, tmp_path, days):
    flights = sample.flights(
        spark, sf_dir, "fl_date", "dest", "dep_delay", "taxi_out", "arr_delay", "distance", "cancelled", "diverted")
    report = studies.exploration(flights, days)
    studies.store_tables(report, "study", str(tmp_path / "study"))
    assert {t.name for t in spark.catalog.listTables("study")} >= set(report)
    assert spark.table("study.counts").first()["n_rows"] == flights.count()
    assert studies.confusion_report(flights).count() == 1
    spark.sql("DROP DATABASE study CASCADE")
    _, results = studies.regression_experiment(flights, days)
    assert set(results) == {
        "all_days", "clean", "categorical", "probabilistic", "near_threshold", "sweep", "ablation", "scaled"}
    a, b = (results[k].first()["rmse"] for k in ("probabilistic", "scaled"))
    assert abs(a - b) < 1e-3


@pytest.mark.parametrize("kind", ["linear", "deep"])
def test_train_classifier(spark, tmp_path, log, kind):
    good = log.where("event = 'arrived' AND arr_delay IS NOT NULL")
    rows = measured(training.training_rows(good).fillna(0.0), "rows")
    report = studies.train_classifier(
        rows, rows, str(tmp_path / "model"), kind, layout="8-4", location=3, airport_buckets=8, max_iter=15).first()
    base = rows.agg(F.avg("ontime")).first()[0]
    assert report["rmse"] < (base * (1 - base)) ** 0.5
    assert (tmp_path / "model" / "stages").exists()


def test_bayes_job(spark, sf_dir, tmp_path):
    from tarmac.sinks.files import read_csv_with_schema

    studies.store_bayes_table(sample.flights(spark, sf_dir, "distance", "dep_delay", "arr_delay"), str(tmp_path / "b"))
    back = read_csv_with_schema(spark, str(tmp_path / "b"))
    assert [f.dataType.simpleString() for f in back.schema] == ["int", "int", "double"]


def test_corrected_lines_parse_back(spark, sf_dir, tmp_path):
    ingest.correct_and_log(
        sample.flights(spark, sf_dir), sample.zoned_airports(spark, sf_dir), str(tmp_path / "c"), str(tmp_path / "l"))
    stored = tables.read_event_log(spark, str(tmp_path / "l"))
    parsed = files.parse_events(stored.select("event_data"), "event_data")
    columns = [c for c in schemas.names(schemas.EVENT_ROW_COLUMNS) if not c.endswith("seq_id")]
    assert parsed.select(columns).exceptAll(stored.select(columns)).count() == 0
    line = stored.select(csv_line("event", "fl_date").alias("v")).first()["v"]
    assert line.split(",")[0] in ("departed", "arrived")
