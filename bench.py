"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the local cores. The raw layer is written first
(it is the input of every query, like the raw tables of a warehouse) and timed on its own.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks import trips
from checks.queries import REGISTERED
from faremill.session import local_session

HEADLINE = [
    "split_overview",
    "staging_trips",
    "obt_trips",
    "rule_diagnostics",
    "column_profile",
    "describe_numeric",
    "correlation_matrix",
    "fare_histogram",
    "distance_box_by_hour",
    "stratified_train_sample",
    "balanced_raw_sample",
    "zone_labels",
    "numeric_preprocessing",
    "feature_matrix_shape",
    "fixed_rate_metrics",
    "metrics_by_month",
    "scored_trips",
    "learner_ridge_regressor",
    "learner_xgboost",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="faremill-bench", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()

    seconds: dict[str, float] = {}
    start = time.perf_counter()
    trips.raw_path(spark, sf_dir)
    seconds["raw_layer"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    total = round(sum(seconds.values()), 3)
    line = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
