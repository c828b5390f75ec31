"""Time the headline queries and print one JSON line.

Each query is planned and run once to warm up, then three times; the median is
reported.  Results go to Spark's no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradeloom.queries import QUERIES  # noqa: E402
from tradeloom.session import local_session  # noqa: E402

HEADLINES = (
    "mart_monthly_sales",
    "mart_category",
    "mart_customer",
    "mart_delivery",
    "fact_sales",
    "merge_fact_sales",
    "fx_attach_asof",
    "rules_order_items",
    "dq_results",
    "measures_bundle",
    "top_customers",
)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cores, shuffle_partitions=int(cores))
    timings = {}
    for name in HEADLINES:
        seconds = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(seconds[1:]), 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
