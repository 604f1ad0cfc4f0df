"""Command line: ``python -m riskladder {quarterly|history|daily|stream} --extracts DIR --as-of YYYY-MM-DD --out PATH``.

``history`` rates every quarter from ``--as-of`` to ``--through`` in one job, each from the statuses the one before left.

``stream`` runs the daily pre-rating over new archive files arriving in
``--archives`` (Parquet), re-reading the other extracts from ``--extracts`` on
each micro-batch; ``--checkpoint`` is the stream's checkpoint folder.

The session comes from spark-submit / the environment; nothing here sets the
master. ``--encoding name=charset`` may repeat (e.g. ``secumain=cp936``).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from riskladder.functions.lookups import read_risk_mapping
from riskladder.plans.jobs import DAILY_INPUTS, daily_job, history_job, judge, quarterly_job, read_inputs
from riskladder.sources.readers import RowCounts
from riskladder.streaming import start_daily_stream


_SAID = {"malformed": "malformed rows", "dropped": "rows without a key", "keys": "repeated keys", "rows": "rows left out for them"}


def _three_months_on(d: dt.date, times: int) -> dt.date:
    month = d.month - 1 + 3 * times
    return dt.date(d.year + month // 12, month % 12 + 1, min(d.day, 28))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="riskladder")
    ap.add_argument("job", choices=["quarterly", "history", "daily", "stream"])
    ap.add_argument("--extracts", required=True, help="folder with <name>.csv (or .parquet) extracts")
    ap.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    ap.add_argument("--out", required=True, help="result table, partitioned by EndDate")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--out-format", default="parquet", choices=["csv", "parquet"])
    ap.add_argument("--encoding", action="append", default=[], metavar="NAME=CHARSET")
    ap.add_argument("--state", help="quarterly: previous result table to take last quarter's state from")
    ap.add_argument("--through", type=dt.date.fromisoformat, help="history: last rating date; one run every three months up to it")
    ap.add_argument("--weekly", help="quarterly: table of weekly states; only the quarter's own return rows are read into it")
    ap.add_argument("--fill-weekly", action="store_true", help="quarterly: fill all quarters of the windows into --weekly")
    ap.add_argument("--mapping", help="basic-level table to use instead of the built-in one (.csv or .yaml)")
    ap.add_argument("--archives", help="stream: folder where new fund archive files arrive")
    ap.add_argument("--checkpoint", help="stream: the stream's checkpoint folder (shared storage)")
    ap.add_argument("--max-bad-rows", type=int, help="fail when an extract has more malformed or keyless rows")
    ap.add_argument("--no-report", action="store_true", help="count no bad rows (filters then reach Parquet extracts)")
    ap.add_argument("--no-type-cut", action="store_true",
                    help="daily: take the newest type even if it starts after the rating date")
    a = ap.parse_args(argv)
    enc = dict(e.split("=", 1) for e in a.encoding)
    builder = SparkSession.builder.appName(f"riskladder-{a.job}")
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if enc:                                        # legacy charsets are a setting of the session
        builder = builder.config("spark.sql.legacy.javaCharsets", "true")
    spark = builder.getOrCreate()
    report: dict | None = None if a.no_report else {}
    if a.job == "quarterly":
        quarterly_job(spark, a.extracts, a.as_of, a.out, a.format, enc, a.state, a.out_format, a.mapping, report, a.max_bad_rows,
                      a.weekly, a.fill_weekly)
    elif a.job == "history":
        dates = [a.as_of]
        while a.through and (later := _three_months_on(a.as_of, len(dates))) <= a.through:
            dates.append(later)
        history_job(spark, a.extracts, dates, a.out, a.format, enc, a.state, a.out_format, a.mapping, report, a.max_bad_rows)
    elif a.job == "daily":
        daily_job(spark, a.extracts, a.as_of, a.out, a.format, enc, a.out_format, not a.no_type_cut, a.mapping, report, a.max_bad_rows)
    else:
        if not (a.archives and a.checkpoint):
            ap.error("stream needs --archives and --checkpoint")

        counts = None

        def dimensions():
            nonlocal counts
            counts = RowCounts() if a.max_bad_rows is not None else None
            t = read_inputs(spark, a.extracts, [n for n in DAILY_INPUTS if n != "fundarchives"], a.format, enc, counts)
            if a.mapping:
                t["mapping"] = read_risk_mapping(spark, a.mapping, "InitialRiskLevel")
            return t
        start_daily_stream(spark, a.archives, dimensions, a.out, a.checkpoint, a.as_of, cut_type_history=not a.no_type_cut,
                           out_format=a.out_format, check=lambda: judge(counts, None, a.max_bad_rows)).awaitTermination()
    for name, counts in (report or {}).items():
        if counts is None:
            print(f"{name}: not read")
        elif any(counts.values()):
            print(f"{name}: " + ", ".join(f"{v} {_SAID[k]}" for k, v in counts.items()))


if __name__ == "__main__":
    main()
