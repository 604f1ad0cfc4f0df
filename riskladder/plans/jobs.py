"""Batch jobs: read the extracts, rate, replace the rated date of the result table.

Every input is named by the caller; nothing is looked for and skipped. The quarterly job
takes last quarter's state (FundSizeStatus, SDStatus) from the ``last_qrt`` extract, or, if
``state_path`` is given, from its own result table, where it is the partition
``EndDate = D2``. The daily job rates share classes missing from the newest published
batch. Paths and the rating date are arguments, never constants or the wall clock.

``report`` (a dict) receives, per extract, malformed and dropped row counts, and for lookups that keep
one row per key the keys with several rows and the rows left out. They are counted by the job's own
reads; each extract is read once, those that a plan uses several times (small ones) through a checkpoint. ``max_bad_rows`` fails the
job, before the result table is touched, when an extract has more. Counting bars filters from being pushed into Parquet extracts;
without ``report`` and ``max_bad_rows`` nothing is counted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskladder.functions import lookups as L
from riskladder.functions.calendar import rating_dates
from riskladder.operators import returns
from riskladder.plans.daily import run_daily
from riskladder.plans.history import run_history
from riskladder.plans.quarterly import run_quarterly
from riskladder.session import materialize
from riskladder.sources import readers, schemas, sinks

QUARTERLY_INPUTS = ["fundarchives", "secumain", "fundtype", "fundrisklevel", "fundtypechangenew",
                    "mainfinancialindex", "last_qrt", "unitnvrestored", "zzqz", "zzzcf"]
DAILY_INPUTS = ["fundarchives", "secumain", "fundtype", "fundrisklevel", "fundtypechangenew", "last_batch", "fundtyperisklevel"]
# small extracts that a plan uses several times
REUSED = {"fundarchives", "fundtype", "last_batch"}


def read_inputs(spark: SparkSession, extract_dir: str, names: list[str], fmt: str = "csv",
                encodings: dict[str, str] | None = None, counts: readers.RowCounts | None = None) -> dict[str, DataFrame]:
    """Read ``{extract_dir}/{name}.{fmt}`` for each name with its declared schema; a missing file fails."""
    out = {}
    for name in names:
        path, enc = f"{extract_dir.rstrip('/')}/{name}.{fmt}", (encodings or {}).get(name)
        if counts is None:
            df = readers.validate(readers.read_extract(spark, name, path, fmt, enc), name)
        else:
            df = readers.read_counted(spark, name, path, fmt, enc, counts)
        out[name] = materialize(df) if name in REUSED and (counts or fmt == "csv") else df
    return out


def judge(counts: readers.RowCounts | None, report: dict | None, max_bad_rows: int | None) -> None:
    """Fill ``report`` and fail when an extract has more bad rows; for use after an action has read the extracts."""
    found = counts.all() if counts else {}
    if report is not None:
        report.update(found)
    for name, c in found.items():
        if max_bad_rows is not None and c and name in schemas.EXTRACTS and sum(c.values()) > max_bad_rows:
            raise ValueError(f"{name}: {c['malformed']} malformed rows and {c['dropped']} rows without a key")


def _watch(counts: readers.RowCounts | None, name: str) -> Callable[..., DataFrame] | None:
    return (lambda df, **c: counts.watch(name, df, **c)) if counts else None


def quarterly_job(spark: SparkSession, extract_dir: str, as_of: dt.date, output: str, fmt: str = "csv",
                  encodings: dict[str, str] | None = None, state_path: str | None = None,
                  out_format: str = "parquet", mapping_path: str | None = None, report: dict | None = None,
                  max_bad_rows: int | None = None, weekly_path: str | None = None, fill_weekly: bool = False) -> DataFrame:
    """Quarterly rating at ``as_of``; replaces partition EndDate = D1 of ``output``.
    ``mapping_path`` replaces the built-in basic-level table (CSV or YAML). With ``weekly_path`` only the quarter's own rows of
    ``unitnvrestored`` are used: they are added to the table of weekly states there, and the volatility is taken from the table;
    ``fill_weekly`` adds all quarters of the windows (a first run, or a correction of history)."""
    names = [n for n in QUARTERLY_INPUTS if n != "last_qrt" or not state_path]
    counts = readers.RowCounts() if report is not None or max_bad_rows is not None else None
    t = read_inputs(spark, extract_dir, names, fmt, encodings, counts)
    dates = rating_dates(as_of)
    if state_path:
        t["last_qrt"] = sinks.read_previous_state(spark, state_path, dates.d2, out_format)
    mapping = L.read_risk_mapping(spark, mapping_path) if mapping_path else L.risk_mapping(spark)
    fund_vol = None
    if weekly_path:
        returns.store_states(t["unitnvrestored"], weekly_path, dates.d9 if fill_weekly else dates.d2, dates.d1)
        fund_vol = returns.volatility_from_states(spark, weekly_path, dates)
    rated = run_quarterly(t, as_of, mapping, watch=_watch(counts, "predecessors"), fund_vol=fund_vol)
    return sinks.replace_date(rated, output, dates.d1, out_format, lambda: judge(counts, report, max_bad_rows))


def history_job(spark: SparkSession, extract_dir: str, as_ofs: list[dt.date], output: str, fmt: str = "csv",
                encodings: dict[str, str] | None = None, state_path: str | None = None, out_format: str = "parquet",
                mapping_path: str | None = None, report: dict | None = None, max_bad_rows: int | None = None) -> DataFrame:
    """Quarterly ratings at all dates of ``as_ofs`` in one job (``plans.history``); replaces the partition of each. The first
    quarter starts from ``last_qrt`` or, with ``state_path``, from that table's partition of the quarter before."""
    names = [n for n in QUARTERLY_INPUTS if n != "last_qrt" or not state_path]
    counts = readers.RowCounts() if report is not None or max_bad_rows is not None else None
    t = read_inputs(spark, extract_dir, names, fmt, encodings, counts)
    runs = [rating_dates(d) for d in sorted(as_ofs)]
    if state_path:
        t["last_qrt"] = sinks.read_previous_state(spark, state_path, runs[0].d2, out_format)
    mapping = L.read_risk_mapping(spark, mapping_path) if mapping_path else L.risk_mapping(spark)
    rated = run_history(t, as_ofs, mapping)
    return sinks.replace_dates(rated, output, sorted({r.d1 for r in runs}), out_format, lambda: judge(counts, report, max_bad_rows))


def daily_job(spark: SparkSession, extract_dir: str, as_of: dt.date, output: str, fmt: str = "csv",
              encodings: dict[str, str] | None = None, out_format: str = "parquet",
              cut_type_history: bool = True, mapping_path: str | None = None, report: dict | None = None,
              max_bad_rows: int | None = None) -> DataFrame:
    """Daily pre-rating at ``as_of``; replaces partition EndDate = as_of - 1 of ``output``."""
    counts = readers.RowCounts() if report is not None or max_bad_rows is not None else None
    t = read_inputs(spark, extract_dir, DAILY_INPUTS, fmt, encodings, counts)
    type_codes = t.pop("fundtyperisklevel")
    mapping = (L.read_risk_mapping(spark, mapping_path, "InitialRiskLevel") if mapping_path
               else L.risk_mapping(spark, "InitialRiskLevel"))
    rated = run_daily(t, as_of, mapping, type_codes, cut_type_history, _watch(counts, "type_codes"))
    return sinks.replace_date(rated, output, as_of - dt.timedelta(days=1), out_format, lambda: judge(counts, report, max_bad_rows))
