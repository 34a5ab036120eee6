"""Times the registered queries on local cores and prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores, ``BENCH_KEYS`` some
queries. Reports and transforms are timed after a warm-up run, ``BENCH_RUNS``
times (median); queries that write files first are timed once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from comarca.session import build_session
from entries import places, reports, steps

RUNS = int(os.environ.get("BENCH_RUNS", "1"))
# Whole runs that differ only in what they report.
LEFT_OUT = {"etl_metrics", "etl_phase", "etl_targets"}


def timed(query, spark, sf_dir):
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_KEYS", "").split()
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        # Small row groups cannot be split further, so let small files use all cores.
        spark__sql__files__openCostInBytes="1048576",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for module, runs, warm_up in ((reports, RUNS, True), (steps, RUNS, True), (places, 1, False)):
        for key, query in module.QUERIES.items():
            if key not in chosen if chosen else key in LEFT_OUT:
                continue
            if warm_up:
                timed(query, spark, sf_dir)
            seconds[key] = round(statistics.median(timed(query, spark, sf_dir) for _ in range(runs)), 4)
            print(key, seconds[key], file=sys.stderr)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
