"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   folder of Parquet tables   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores                (default 8)
    BENCH_RUNS     timed runs per query, the median counts, after one warm-up (default 1)
    BENCH_QUERIES  comma-separated query names instead of the headline set
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tallygraph.queries import QUERIES
from tallygraph.session import build_session
from tallygraph.storage import release

HEADLINE = [
    "word_count",
    "grep_count",
    "key_distribution",
    "right_outer_join",
    "salted_group_agg",
    "bucketed_join",
    "log_query",
    "load_delay_histogram",
    "group_detection",
    "group_relation",
    "user_group",
    "pagerank_links",
    "pagerank_static",
    "connected_components",
    "triangle_count",
    "label_propagation",
    "sssp",
    "kmeans_fixed_rounds",
    "logreg_fixed_rounds",
    "stream_running_count",
    "stream_sliding_count",
    "stream_stateful_count",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus),
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, folder)  # warm-up: class loading and code generation
        seconds[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    release(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
