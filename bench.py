"""Seconds per headline query on the given tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from plugtide.functions.durable import intermediate_tables
from plugtide.plans import catalog
from plugtide.plans.fixture import Fixture

HEADLINE = [
    "clean_sessions",
    "grid_from_days",
    "point_features",
    "station_rollup",
    "interactions",
    "training_matrix",
    "roc_auc",
    "pr_curve",
    "tune_threshold",
    "classification_report",
    "train_models_stations",
]
WARM_UP = "/root/testdata/sf0.001"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = os.path.join(os.path.dirname(os.path.abspath(__file__)), "spark-warehouse")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("plugtide-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", folder)
        .config("spark.checkpoint.dir", f"{folder}/_shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    entries, seconds = catalog.entries(), {}

    def wide_search(folder: str) -> DataFrame:
        """The search with more and deeper trees than the registered query of this name has."""
        return catalog.train_models(Fixture(spark, folder), replace(catalog.BY_STATION, **catalog.WIDE_SEARCH))

    def run(name: str, folder: str) -> float:
        started = time.perf_counter()
        with intermediate_tables(spark):
            df = wide_search(folder) if name == "train_models_stations" else entries[name].query(spark, folder)
            df.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    # Start-up and compilation are not part of any query's time.
    for name in ("training_matrix", "roc_auc"):
        run(name, WARM_UP)
    for name in HEADLINE:
        seconds[name] = run(name, sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
