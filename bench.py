"""Times the headline queries and prints one JSON line.

Every query runs once to warm up and then BENCH_RUNS times, or fewer once its timed
runs have taken BENCH_ENOUGH seconds; the median counts.
Building the query, planning and running it into the ``noop`` sink all count.
``--direct`` times the direct forms of the queries that have one instead.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from suite.direct import DIRECT  # noqa: E402
from suite.queries import QUERIES  # noqa: E402

HEADLINE = (
    "mart_sales",
    "fact_order",
    "join_full_outer_products",
    "join_left_order_lines",
    "mart_frequent_customer",
    "outlier_z_chain",
    "outlier_iqr_remove",
    "profile_all",
    "profile_histogram",
    "cast_contract",
    "pk_report",
    "zip_valid",
    "dedupe_chain",
    "dedupe_composite_key",
    "normalize_strip",
    "udf_batch_predicate",
    "cleanse_order_items",
    "kpi_sales_totals",
    "kpi_revenue_state",
    "kpi_brand_loyalty",
    "kpi_retention_yoy",
    "kpi_clv",
    "run_mart_counts",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(build, spark: SparkSession, sf_dir: str, runs: int, enough: float) -> float:
    taken = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - start)
        if sum(taken[1:]) > enough:
            break
    return round(statistics.median(taken[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    enough = float(os.environ.get("BENCH_ENOUGH", "20"))
    chosen = DIRECT if "--direct" in sys.argv else {n: QUERIES[n] for n in HEADLINE}
    spark = session(cpus)
    times = {n: seconds(build, spark, sf_dir, runs, enough) for n, build in chosen.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
