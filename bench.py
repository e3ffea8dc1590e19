"""Times the headline queries: warm, median of three runs, one JSON line.

Each run of a query also makes the inputs it reads as files or tables (landed documents, stored forecasts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "parse_chart", "parse_ohlc", "chart_dedup", "lag_features", "standardize", "feature_train", "forecasts",
    "control_limits", "model_performance", "forecast_metrics", "error_pivot", "top_test_errors",
    "coverage", "duplicate_keys", "cadence_summary", "time_gaps", "describe_market", "returns", "return_outliers",
    "rolling_price", "rolling_volatility", "correlations", "price_lag_corr", "price_histogram", "return_boxplot",
    "dash_ohlc", "dash_history", "dash_price_cards", "dash_price_line",
    "trend_test", "adf_test", "kpss_test", "price_acf", "return_pacf",
)
# Timed too, but not part of the total: the route for series that are too long for one task.
LONG = ("lag_features_long", "rolling_price_long", "standardize_long", "forecasts_long", "return_boxplot_long",
        "price_acf_long", "kpss_test_long", "adf_test_long")
RUNS = 3


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in (*HEADLINE, *LONG):
        seconds(spark, name, sf_dir)
        timings[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings[n] for n in HEADLINE), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
