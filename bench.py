"""Time the headline queries and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS (median of so many runs) steer it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "seller_category_kpis",
    "seller_kpis",
    "kpi_correlation",
    "kpi_boxstats",
    "order_features",
    "assembled_items",
    "items_with_cluster",
    "daily_facts",
    "daily_facts_by_category",
    "monthly_rollup",
    "region_month_revenue",
    "late_by_review",
    "price_freight_outliers",
    "interpolate",
    "outlier_median",
    "series_repair",
    "classical_additive",
    "fourier_decompose",
    "holt_fit",
    "ets_auto",
    "arima_auto",
    "accuracy",
    "kmeans_sellers",
    "profile_forecast",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("supplycast-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        # small files stand for much arithmetic here: keep a task per core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, folder: str) -> float:
    """Seconds to compute every row of the result, without moving it to the driver."""
    begin = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = session()
    run(spark, "status_share", folder)  # start the session's workers
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    seconds = {
        name: round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
        for name in names
    }
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
