"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from tarmac.session import build_session
from tarmac.catalog import QUERIES

HEADLINE = [
    "delay_by_departure_delay", "delay_describe_clean", "delay_ventiles", "conditional_quantile",
    "outlier_threshold_sweep", "decision_eval", "banded_eval", "origin_average_delay",
    "distance_delay_hist2d", "bayes_ontime_table", "sample_by_key", "train_semi", "clean_lines",
    "header_check", "arity_check", "utc_times", "flight_events", "event_payload", "good_flights",
    "origin_hour_delay", "with_departure_average", "sliding_arrival_delay",
    "trailing_hour_arrival_delay", "slice_arrival_delay", "features_per_window", "training_set",
    "test_set", "logistic_eval", "prediction_csv", "csv_roundtrip",
    "minute_counts_stream", "sliding_stream", "cogroup_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        app="tarmac-bench", master=f"local[{cpus}]", spark_sql_shuffle_partitions=cpus,
        spark_ui_enabled="false", spark_driver_memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total wall-clock of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
