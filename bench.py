"""Benchmark: headline feed pipelines at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through the noop sink (the whole plan executes, nothing is collected);
queries that write (history_snapshot, ingest_partition, recon_report, stage_landing) include their writes.
One warm-up, then the median of $BENCH_REPS runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "incremental_snapshot",
    "history_snapshot",
    "ingest_partition",
    "recon_difference",
    "recon_report",
    "file_table_validation",
    "schema_validation",
    "stage_landing",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    if not cpus.isdigit():  # e.g. "*"
        cpus = str(os.cpu_count() or 8)
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE

    from feedlake.registry import QUERIES
    from feedlake.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="feedlake-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times = {}
    for name in names:
        run(name)  # warm-up
        times[name] = round(statistics.median(run(name) for _ in range(reps)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus), "reps": reps}))


if __name__ == "__main__":
    main()
