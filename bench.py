"""Benchmark of the headline queries.

Runs each query of HEADLINE at $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS], writing the full result to the ``noop`` sink (so the
whole plan runs, nothing is collected). One warm-up pass at sf0.001 first,
then $BENCH_REPEATS timed runs per query (median). Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockcast.plans.catalog import queries  # noqa: E402
from stockcast.session import local_session  # noqa: E402

HEADLINE = [
    "order_table",
    "project_snapshot",
    "project_on_stock",
    "project_on_order",
    "projections_merged",
    "stream_projection",
]


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus) * 2) if cpus.isdigit() else 16, app="stockcast-bench")
    qs = queries()
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm):
        for name in HEADLINE:
            run_once(spark, qs[name], warm)
    times = {}
    for name in HEADLINE:
        times[name] = round(statistics.median(run_once(spark, qs[name], sf_dir) for _ in range(repeats)), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
