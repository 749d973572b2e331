"""Time the headline queries; prints one JSON line.

Tables come from $BENCH_SF_DIR (default sf0.1), cores from $BENCH_CPUS.  Each
query is written to Spark's no-op sink, so all of its rows are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "clean_listings",
    "clean_good_rows",
    "quality_report",
    "dedupe_listings",
    "parse_number_eu",
    "skw_product_name",
    "result_view",
    "sort_price_asc",
    "land_options",
    "raw_csv_scan",
    "page_cards",
    "raw_listings",
    "page_walk",
    "run_search",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("clean_good_rows")  # start the JVM and warm up what cleaning needs
    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
