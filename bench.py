"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed runs
per query (the median is reported; one more run before them warms the session up).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventlode.plans.queries import QUERIES  # noqa: E402
from eventlode.session import build_session  # noqa: E402

BATCH = [
    "mart_dau", "mart_revenue", "mart_churn", "kpi_summary", "kpi_revenue_top", "dedup_events",
    "silver_tumbling_batch", "silver_sessions_batch", "explode_sessions", "users_from_sessions",
    "json_parse", "dlq_rate", "registry_validate", "corruption_classify", "scd2_full", "revenue_by_plan_pit",
    "fact_build", "fact_purchases_build", "view_denormalized", "surrogate_keys", "dq_volume", "dq_nulls",
    "test_unique", "test_relationships",
]
STREAMING = ["bronze_ingest", "silver_tumbling", "silver_sessions", "dedup_stream", "live_dau", "live_revenue"]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in BATCH:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    for name in STREAMING:
        seconds[name] = round(timed(spark, name, sf_dir), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
