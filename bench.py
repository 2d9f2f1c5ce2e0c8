"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default ``/root/testdata/sf0.1``) and
``BENCH_CPUS`` the cores. Each query runs once to warm up and then three times
(merges and streams once); the median counts, from building the query to
writing its last row away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import views  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from tarmac.operators import metrics  # noqa: E402
from tarmac.operators.features import business_features  # noqa: E402
from tarmac.sources.shared import shared_folder  # noqa: E402

HEADLINE = [
    "airport_hourly",
    "flight_performance",
    "business_features",
    "json_flatten_events",
    "classify_pages",
    "reference_family",
    "dim_airports",
    "dim_airlines",
    "quarantine_split",
    "dedup_lineitem",
    "upsert_scd1",
    "cdc_latest",
    "page_gaps",
    "coverage_gaps",
    "page_dupes",
]
# Stored merges and streams: slower, so timed once after the warm-up.
PRODUCT = [
    "keyed_table_upsert",
    "stream_quarantine",
    "stream_fact_flights",
    "stream_gold_hourly",
    "stream_gold_performance",
    "stream_landing",
]


def timed(build, runs: int = 3) -> float:
    seconds = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tarmac-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Off: it records a Python stack trace for every expression built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: timed(lambda name=name: QUERIES[name](spark, sf_dir)) for name in HEADLINE}
    for name in PRODUCT:
        queries[name] = timed(lambda name=name: QUERIES[name](spark, sf_dir), runs=1)

    # The gold tables as the pipeline builds them: from a fact that is already stored.
    fact_path = f"{shared_folder(spark)}/fact"
    views.flights(spark, sf_dir).write.parquet(fact_path)
    fact = spark.read.parquet(fact_path)
    queries["hourly_from_fact"] = timed(lambda: metrics.airport_hourly(business_features(fact)))
    queries["performance_from_fact"] = timed(
        lambda: metrics.flight_performance(business_features(fact))
    )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(sf_dir),
            }
        )
    )


if __name__ == "__main__":
    main()
