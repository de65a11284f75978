"""Time the headline queries; prints one JSON line.

``$BENCH_SF_DIR`` names the tables, ``$BENCH_CPUS`` the local cores. Each query runs
once to warm up and then three times; the median counts. Of a query that takes longer than
``LONG`` seconds the first run counts. Results are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402

LONG = 20

HEADLINE = [
    "silver_clean",
    "cleaning_report_lineitem",
    "parquet_partition_roundtrip",
    "parquet_partition_lineitem",
    "dim_zeit",
    "fact_star_join",
    "fact_star_join_lineitem",
    "gold_verify",
    "module_month_report",
    "module_month_report_lineitem",
    "explore_groups_1000",
    "explore_day_grain",
    "sensor_bucket_avg",
    "csv_tree_roundtrip",
    "job_chain",
    "job_chain_monthly",
    "job_chain_lineitem",
]


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        first = run(spark, name, sf_dir)
        times = [first] if first > LONG else [run(spark, name, sf_dir) for _ in range(3)]
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
