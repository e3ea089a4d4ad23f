"""Wall seconds per query: build the plan and write every row to nowhere.

Folder from ``BENCH_SF_DIR``, cores from ``BENCH_CPUS``, names from the command
line (default: the headline queries). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "s01_read_readings_xml_split",
    "f_all_kinds",
    "f14_interval",
    "e02_number_rows",
    "e08_topology_request",
    "e09_join_relation_flags",
    "e10_join_variable_flags",
    "e12_add_utc",
    "c04_reject_out_of_window",
    "c07_resolve_duplicates",
    "c08_latest_version",
    "c09_assign_version",
    "c10_usage_reading",
    "c12_expected_grid",
    "c13_fill_gaps",
    "c16_complete_fill",
    "c17_validate_intervals",
    "c18_series_summary",
    "a01_reading_audit",
    "clean_accepted",
    "completeness_by_series",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from catalog import QUERIES

    names = sys.argv[1:] or HEADLINE
    QUERIES["c18_series_summary"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
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
