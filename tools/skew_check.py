"""Hot-key check for the volatility aggregation.

    python tools/skew_check.py [sf_dir]

Builds a return series from lineitem in which one fund holds a third of all
rows, runs ``volatility_quarters`` with an event log in a scratch folder, and
prints, per shuffle stage, the largest number of records any single reduce task
read next to the total. A skew-safe plan keeps the largest task far below a
third of the input.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_events(folder):
    import zstandard
    for f in sorted(glob.glob(os.path.join(folder, "*", "events*")) + glob.glob(os.path.join(folder, "*.zstd"))):
        with open(f, "rb") as fh:
            stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            for line in stream:
                yield json.loads(line)


def main(argv):
    from pyspark.sql import functions as F
    from riskladder.functions.calendar import rating_dates
    from riskladder.operators.returns import volatility_quarters
    from riskladder.session import build_session
    from riskladder.sources import standins

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    events = tempfile.mkdtemp(prefix="riskladder-events-")
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": events,
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    series = standins.unitnvrestored(spark, sf_dir)
    hot = series.withColumn("InnerCode", F.when(F.hash("TradingDay", "NVRDailyGrowthRate", "UnitNVRestored") % 3 == 0,
                                                F.lit(0)).otherwise(F.col("InnerCode")))
    total = hot.count()
    hot_rows = hot.filter(F.col("InnerCode") == 0).count()
    spark.sparkContext.setJobGroup("measure", "volatility with a hot key")
    volatility_quarters(hot, rating_dates(__import__("datetime").date(2001, 2, 15))).write.format("noop").mode("overwrite").save()
    spark.stop()

    jobs, per_stage = set(), {}
    for e in read_events(events):
        if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == "measure":
            jobs.update(e["Stage IDs"])
        if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in jobs:
            m = e.get("Task Metrics") or {}
            read = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            scanned = (m.get("Input Metrics") or {}).get("Records Read", 0)
            per_stage.setdefault(e["Stage ID"], []).append((read, scanned))
    print(f"input rows {total}, hot fund rows {hot_rows} ({hot_rows / total:.0%})")
    for sid, tasks in sorted(per_stage.items()):
        reads = [r for r, _ in tasks]
        scans = [s for _, s in tasks]
        if sum(reads):
            print(f"stage {sid}: shuffle records read total {sum(reads)}, largest task {max(reads)} "
                  f"({max(reads) / max(sum(reads), 1):.1%}) over {len(tasks)} tasks")
        else:
            print(f"stage {sid}: scan {sum(scans)} rows over {len(tasks)} tasks, largest task {max(scans)}")


if __name__ == "__main__":
    main(sys.argv)
