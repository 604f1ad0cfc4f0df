"""Benchmark the headline rating queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query is executed in full through the ``noop`` sink (no collect, no
output files). One warm-up pass at the smallest scale compiles the generated
code first; each headline query is then declared afresh and timed three times at the
requested scale (the median counts, their sum is the value); all other queries of the rating method are timed once and
listed too. The training-data queries are measured by their own tool, on larger tables. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "rating_quarterly", "rating_daily", "rating_base", "master",
    "volatility_4q", "weekly_return", "benchmark_row", "sd_flag",
    "nav_pivot", "size_flag", "asof_latest", "join_anti", "propagate_main",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from riskladder.session import build_session
    from riskladder.plans.catalog import QUERIES

    scratch = tempfile.mkdtemp(prefix="riskladder-bench-")
    spark = build_session(f"local[{cpus}]", app="riskladder-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "8g",
                                 "spark.local.dir": scratch})
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for name in HEADLINE:
            run(QUERIES[name](spark, warm))

    times = {}
    for name in [*HEADLINE, *sorted(set(QUERIES) - set(HEADLINE))]:
        took = []
        for _ in range(3 if name in HEADLINE else 1):
            t0 = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            took.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(took), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    t0 = time.perf_counter()
    sum(range(10_000_000))                  # machine-speed probe, not part of the total
    probe = round(time.perf_counter() - t0, 3)
    print(json.dumps({"metric": "total_headline_query_time", "value": round(sum(times[n] for n in HEADLINE), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus),
                      "cpu_probe_sec": probe}))


if __name__ == "__main__":
    main()
