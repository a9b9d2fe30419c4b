"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_RUNS     runs of each query (default 3)
    BENCH_QUERIES  comma-separated names (default: all headline queries)

Each result is written to Spark's no-op sink, so every row is produced and none
is collected. A query's figure is the median of ``BENCH_RUNS`` runs, three unless set;
the first of them is the one that compiles.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = [
    "products_sold",
    "users_by_hour",
    "regional_sales",
    "windowed_sales",
    "late_events_dlq",
    "enriched_lines",
    "regional_orders",
    "bronze_latest",
    "as_of_version",
    "snapshots",
    "branch_read",
    "branch_diff",
    "total_count",
    "dedup",
    "duplicate_report",
    "lateness_profile",
    "status_violations",
    "out_of_order",
    "current_status",
    "session_bursts",
    "sliding_bursts",
    "partitioned_lateness",
    "region_share",
    "price_check",
    "decode_lenient",
    "message_round_trip",
    "compacted_equals_source",
    "branch_publish",
    "bucketed_latest",
    "bucketed_join",
    "ingest_stream",
    "products_sold_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from tablestream.plans import QUERIES
    from tablestream.session import build_session

    spark = build_session(
        "bench",
        f"local[{cpus}]",
        cpus,
        {"spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    run("preview")
    seconds = {}
    for name in names:
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
