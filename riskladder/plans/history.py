"""Quarterly ratings of many quarters in one job.

A quarter starts from the statuses that the quarter before it left, so the single job has to run
once per quarter, each run reading every input again. Here every input is read once:

* type history and official ratings at all rating dates: ``asof.latest_at_dates``;
* net assets: summed once per quarter, each sum used by the runs that look back on it;
* volatility: one pass over the return series for all windows;
* the state machine: only the main share class (or the first of a fund's classes) decides, so a fund
  has one record per quarter, and its records, in order, are folded (``rules.fold_ratings``).

The outcomes are joined back to all share classes of the fund and quarter, as the single run propagates them.
A fund code that holds a third of the rows is one record per quarter after a partial aggregate.

A class that leads its fund in a quarter carries the fund's statuses on if the class itself was rated in the
quarter before; if not (new, or not alive then) it starts without statuses, as it does in the single run. The
first quarter starts from ``last_qrt``. Where a quarter is missing from the list, the next one starts without
statuses too. Rows without a fund code are one fund, as in the single run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskladder.functions import rules as R
from riskladder.functions.calendar import rating_dates
from riskladder.operators.benchmark import benchmark_aggregates
from riskladder.operators.returns import volatility_history
from riskladder.operators.sizing import nav_history
from riskladder.plans.master import master_history
from riskladder.plans.quarterly import FINAL_COLUMNS, PROPAGATED, base_rating_quarterly, result_names, result_table, with_flags
from riskladder.session import materialize


def run_history(t: dict[str, DataFrame], as_ofs: list[dt.date], mapping: DataFrame) -> DataFrame:
    """The rows of ``run_quarterly`` for every date of ``as_ofs`` (the last one of a quarter), each quarter starting from the
    statuses of the one before. ``t`` as for ``run_quarterly``."""
    runs = sorted({r.d1: r for r in map(rating_dates, sorted(as_ofs))}.values(), key=lambda r: r.d1)
    if not runs:
        raise ValueError("no rating date")
    calendar = F.create_map(*[F.lit(x) for r in runs for x in (r.d1, r.d2)])
    given = F.create_map(*[F.lit(x) for r in runs for x in (r.d1, r.as_of)])
    master = master_history(t["secumain"], t["fundarchives"], t["fundtype"], t["fundrisklevel"], t["fundtypechangenew"], [r.d1 for r in runs])
    base = base_rating_quarterly(master.withColumn("D2", calendar[F.col("D1")]), mapping, None)

    index_series = t["index_quotes"] if "index_quotes" in t else t["zzqz"].unionByName(t["zzzcf"])
    index_vol = volatility_history(index_series, runs, rate="ChangePCT")
    bench = index_vol.groupBy("D1").agg(*benchmark_aggregates())
    bench = bench.select("D1", F.struct(*[c for c in bench.columns if c != "D1"]).alias("_bench"))
    nav = t["mainfinancialindex"].join(t["fundarchives"].select("InnerCode", "MainCode"), "InnerCode", "left")
    df = (base.join(bench, "D1", "left").join(nav_history(nav, runs), ["MainCode", "D1"], "left")
          .join(volatility_history(t["unitnvrestored"], runs), ["InnerCode", "D1"], "left"))
    state = t["last_qrt"].select("InnerCode", F.col("FundSizeStatus").alias("_size"), F.col("SDStatus").alias("_sd"),
                                 F.lit(runs[0].d1).alias("D1"))
    df = with_flags(df, F.col("D1")).join(state, ["InnerCode", "D1"], "left")
    # rated in the quarter before: a class has one row per quarter, so the window holds few rows
    rated = F.collect_set("D1").over(Window.partitionBy("InnerCode"))
    df = df.withColumn("_carried", F.array_contains(rated, F.col("D2")))
    kept = [c for c in FINAL_COLUMNS if c not in PROPAGATED]
    own = ["RiskLevel", "SDStatus", "FundSizeStatus"]      # of the rule's outcome; named here for the renames
    df = result_names(df.withColumns({"FinalRiskLevel": F.lit(None).cast("string")}))
    record = F.struct("D1", F.col("BasicRiskLevel").alias("level"), F.col("EstablishmentLength").alias("months"),
                      F.col("NetAssetFlag").alias("size_flag"), F.col("SDFlag").alias("sd_flag"), F.col("ChangeReason").alias("reason"),
                      F.col("_carried").alias("carried"), F.col("_size").cast("int").alias("size_status"),
                      F.col("_sd").cast("int").alias("sd_status"), F.col("OfficialRiskLevel").alias("official"))
    df = materialize(df.drop(*own).select(*kept, "D1", "IsMain", record.alias("_record")))
    leads = df.groupBy("MainCode", "D1").agg(F.min_by("_record", F.struct("IsMain", "InnerCode")).alias("r"))
    funds = leads.groupBy("MainCode").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    none = F.lit(None).cast("int")
    folded = funds.select(F.col("MainCode").alias("_main"), "rs", R.fold_ratings(F.col("rs"), none, none).alias("out"))
    folded = folded.select("_main", F.explode(F.arrays_zip("rs", "out")).alias("x")).select(
        "_main", F.col("x.rs.D1").alias("_d1"), F.col("x.out.level").alias("RiskLevel"), F.col("x.out.reason").alias("ChangeReason"),
        F.col("x.out.size_status").alias("FundSizeStatus"), F.col("x.out.sd_status").alias("SDStatus"), F.col("x.rs.official").alias("OfficialRiskLevel"))
    folded = folded.withColumn("ChangeDirection", R.change_direction("ChangeReason"))
    out = df.join(folded, df["MainCode"].eqNullSafe(folded["_main"]) & (F.col("D1") == F.col("_d1")), "left")
    return result_table(out, F.col("D1"), given[F.col("D1")])
