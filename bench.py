"""Times the registered queries on one machine and prints one JSON line.

Settings: BENCH_SF_DIR (table folder), BENCH_CPUS (cores), BENCH_RUNS (timed runs per query, three by
default; the median counts), BENCH_QUERIES (comma-separated names; default all).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from peopleflow.plans.catalogue import QUERIES
from peopleflow.session import build_session, drop_staged


def run_once(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = build_session(
        "peopleflow-bench",
        f"local[{cores}]",
        spark__sql__shuffle__partitions=cores,
        spark__driver__memory="16g",
        spark__log__level="ERROR",
    )
    seconds = {}
    for name in names:
        taken = []
        run_once(spark, name, folder)  # warm up
        for _ in range(runs):
            taken.append(run_once(spark, name, folder))
        seconds[name] = round(statistics.median(taken), 4)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    drop_staged(spark)
    spark.stop()
    result = {
        "metric": "total_seconds_all_queries",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf") or 0),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
