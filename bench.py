"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the scale folder, ``BENCH_CPUS`` the local cores. Each query computes
every row of its result and writes it nowhere; the figure is the median of three runs.
``python bench.py all`` times every registered query, ``python bench.py NAME ...`` the named.
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

from ledgerstar.catalogue import QUERIES  # noqa: E402
from ledgerstar.session import SESSION_SETTINGS  # noqa: E402

HEADLINES = [
    "star_join",
    "left_key_attach",
    "orphan_rows",
    "orphan_report",
    "latest_per_key",
    "dimension_extract",
    "concat_dedup",
    "row_and_distinct_counts",
    "profile_table",
    "null_profile",
    "unique_failures",
    "data_test_report",
    "surrogate_key",
    "card_enrichment",
    "safe_casts",
    "csv_scan_typed",
    "partitioned_fact",
    "incremental_load",
    "build_fact",
    "bronze_silver_gold",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    settings = SESSION_SETTINGS | {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # start the session's threads

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    names = list(QUERIES) if sys.argv[1:] == ["all"] else sys.argv[1:] or HEADLINES
    seconds = {}
    for name in names:
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
