"""Time the headline queries and print one JSON line.

Each query is run to its full result (a no-op sink takes every row); the best of
the timed repeats counts, after one untimed run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartloom.plans import load_all
from cartloom.plans.registry import QUERIES
from cartloom.session import build_session, release

HEADLINE = [
    "core_revenue",
    "sort_large_join",
    "pricing_summary",
    "top_products",
    "incremental_aggregate",
    "category_summary",
    "monthly_revenue",
    "supplier_report",
    "join_three_way",
    "order_sequence",
    "customer_behaviour",
    "cohort_new_returning",
    "rfm",
    "event_funnel",
    "json_paths",
    "merge_upsert",
    "change_feed",
    "as_of_state",
    "billed_seconds",
    "sentiment_score",
    "top_terms_per_group",
    "csv_load_typed",
    "stream_cdc_merge",
]


def timed(spark, fn, path: str) -> float:
    start = time.perf_counter()
    fn(spark, path).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    load_all()
    spark = build_session("bench", cpus)
    spark.conf.set("spark.sql.shuffle.partitions", cpus)
    seconds = {}
    for key in HEADLINE:
        fn = QUERIES[key]
        timed(spark, fn, path)
        seconds[key] = round(min(timed(spark, fn, path) for _ in range(repeats)), 3)
    release(spark)
    spark.stop()
    sf = os.path.basename(path.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(sf)}))


if __name__ == "__main__":
    main()
