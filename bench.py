"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the local threads, and
``BENCH_QUERIES`` may list queries to run instead of the headline ones. Results go to the
``noop`` sink, so every column of every row is computed and none is brought to the driver.
"""

from __future__ import annotations

import json
import logging
import os
import sys
import time

from postbud.queries.catalog import queries
from postbud.session import build_session

HEADLINE = (
    "request_ids", "key_profile", "unmapped_ids", "map_duplicates", "numbered_rows",
    "geo_latest", "geo_fixes", "kommune_filled", "delivery_rows", "delivery_strict_types",
    "year_backfill", "qc_summary", "delivery_counts", "month_control", "gates", "run_metrics",
    "empty_columns", "missing_layout_columns", "mojibake_repair", "mojibake_count", "header_keys",
    "parse_dates", "month_suffix_counts", "integer_cast", "newest_inputs", "read_exports",
    "cached_exports", "csv_roundtrip", "delivery_table", "run_requests", "run_deliveries",
)


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    logging.getLogger("postbud").setLevel(logging.ERROR)
    spark = build_session(
        "postbud-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    seconds(registered["qc_summary"], spark, sf_dir)  # let the JVM warm up
    times = {}
    for name in names:
        times[name] = round(seconds(registered[name], spark, sf_dir), 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
