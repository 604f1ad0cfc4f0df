"""Quarterly rating: base level from type and rules, then the size / volatility
uplift state machine against last quarter's state, then share-class propagation.

Benchmarks stay in the plan as a scalar sub-query, the quarter pivot has explicit
labels, the volatility is one pass. With ``checkpoint`` (the default) two eager jobs
write checkpoints while the query is declared; the result is computed by the write.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskladder.functions import lookups as L
from riskladder.functions import rules as R
from riskladder.functions.calendar import QUARTER_LABELS, RatingDates, rating_dates, tenure_months
from riskladder.operators.asof import alive_at
from riskladder.operators.benchmark import benchmark_scalar, factors_and_standards, with_benchmark
from riskladder.operators.joins import attach_predecessor, left_lookup, predecessors
from riskladder.operators.propagate import propagate_first
from riskladder.operators.returns import volatility_quarters
from riskladder.operators.sizing import nav_by_quarter
from riskladder.plans.master import build_master
from riskladder.session import materialize

# fixed values: lookup keys, output columns, propagated and zero-filled columns
NAME_KEYS = ["FundTypeName1", "FundTypeName2", "FundTypeName3"]

FINAL_COLUMNS = [
    "InnerCode", "MainCode", "SecuCode", "ApplyingCodeFront", "ApplyingCodeBack", "SecuAbbr",
    "EstablishDate", "FirstCategory", "FirstCategoryName", "SecondCategory", "SecondCategoryName",
    "ThirdCategory", "ThirdCategoryName", "BasicRiskLevel", "FundSizeStatus", "SDStatus",
    "LastQrtNV", "SecondQrtNV", "ThirdQrtNV", "ForthQrtNV", "LastQrtSD", "SecondQrtSD",
    "ThirdQrtSD", "ForthQrtSD", "LastQrtSDFactor", "SecondQrtSDFactor", "ThirdQrtSDFactor",
    "ForthQrtSDFactor", "RiskLevel", "ChangeDirection", "ChangeReason", "OfficialRiskLevel",
]
PROPAGATED = ["RiskLevel", "ChangeDirection", "ChangeReason", "SDStatus", "FundSizeStatus", "OfficialRiskLevel"]
ZERO_FILLED = ["ForthQrtNV", "LastQrtNV", "SecondQrtNV", "ThirdQrtNV",
               "LastQrtSD", "SecondQrtSD", "ThirdQrtSD", "ForthQrtSD",
               "LastQrtSDFactor", "SecondQrtSDFactor", "ThirdQrtSDFactor", "ForthQrtSDFactor",
               "FundSizeStatus", "SDStatus"]


def _replace_if(col: str, word: str, new: str, source: str | None = None) -> Column:
    """If ``col`` contains ``word``, ``source`` (default ``col``) with word -> new."""
    src = F.col(source or col)
    return F.when(F.col(col).contains(word), F.replace(src, F.lit(word), F.lit(new))).otherwise(F.col(col))


def fof_names(df: DataFrame) -> DataFrame:
    """FOF renames. Level 3 is rebuilt from the level-1 name (a rule of the method)."""
    return df.withColumns({
        "FundTypeName2": _replace_if("FundTypeName2", "FOF", "股票FOF"),
        "FundTypeName3": _replace_if("FundTypeName3", "FOF", "股票FOF", source="FundTypeName1"),
    })


def _once(df: DataFrame, checkpoint: bool) -> DataFrame:
    return materialize(df) if checkpoint else df


def base_rating_quarterly(master: DataFrame, mapping: DataFrame, dates: RatingDates | None, checkpoint: bool = True,
                          watch: Callable[..., DataFrame] | None = None) -> DataFrame:
    """Mapping lookup, X1, name normalisation, predecessors, alive filter, X2, remark.

    ``checkpoint`` computes the frame that feeds both sides of the predecessor
    self-join once (see ``session.materialize``); without it the plan computes it twice.
    ``watch`` counts predecessors left out because others have their code and date. Without
    ``dates`` the frame holds several runs, their dates in columns D1 and D2.
    """
    by = [] if dates else ["D1"]
    d1, d2 = (dates.d1, dates.d2) if dates else (F.col("D1"), F.col("D2"))
    df = left_lookup(master, mapping, NAME_KEYS)
    df = R.apply_base_rule(df, "RiskLevel", "InitRiskLevel")
    df = df.withColumns({
        "FundTypeName2": _replace_if("FundTypeName2", "指数型", "指数"),
        "FundTypeName1": _replace_if("FundTypeName1", "债券基金", "债券基金（不含封闭式）"),
    })
    df = _once(df, checkpoint)                             # feeds both sides of the self-join
    pred = predecessors(df, d2, watch, by)                 # taken before the alive filter
    df = df.filter(alive_at("EstablishmentDate", "ExpireDate", d1))
    df = df.withColumn("InitRiskLevel", R.special_rule_quarterly("ChiName", "SecurityCode", "InitRiskLevel"))
    df = attach_predecessor(df, pred, by)
    df = df.withColumn("ChangeReason", R.conversion_remark("PreviousFundTypeName3"))
    df = fof_names(df)
    return df.withColumn("SecurityCode", F.replace(F.col("SecurityCode"), F.lit("J"), F.lit("")))


def with_flags(df: DataFrame, d1: dt.date | Column) -> DataFrame:
    """Tenure, size flag, volatility factors and volatility flag of rows that carry the quarters' sums and
    deviations and the benchmark (``_bench``)."""
    df = df.withColumns({
        "EstablishmentLength": tenure_months(d1, F.col("EstablishmentDate")),
        "NetAssetFlag": R.size_flag(*[f"{q}QrtNV" for q in reversed(QUARTER_LABELS)]),
    })
    df = df.withColumns(factors_and_standards(F.col("InitRiskLevel"), F.col("_bench"))).drop("_bench")
    return df.withColumn("SDFlag", R.sd_flag([f"{q}QrtSD" for q in QUARTER_LABELS], [f"{q}QrtStandard" for q in QUARTER_LABELS]))


def result_names(df: DataFrame) -> DataFrame:
    """Names of the result table, and IsMain (1: main share class)."""
    df = df.drop("RiskLevel").withColumnsRenamed({
        "FundTypeName1": "FirstCategoryName", "FundTypeName2": "SecondCategoryName",
        "FundTypeName3": "ThirdCategoryName", "FundTypeCode1": "FirstCategory",
        "FundTypeCode2": "SecondCategory", "FundTypeCode3": "ThirdCategory",
        "InitRiskLevel": "BasicRiskLevel", "FinalRiskLevel": "RiskLevel",
        "SecurityCode": "SecuCode", "EstablishmentDate": "EstablishDate",
    })
    return df.withColumn("IsMain", F.when(F.col("MainCode") == F.col("SecuCode"), 1).otherwise(2))


def result_table(df: DataFrame, d1: dt.date | Column, as_of: dt.date | Column) -> DataFrame:
    """The 41 output columns of rated rows."""
    df = df.select(*FINAL_COLUMNS, F.lit(d1).alias("EndDate"), F.lit(as_of).alias("_as_of")).withColumns({
        "RLDivisionMode": F.lit(2),
        "HigherRiskLevel": R.higher_level("RiskLevel", "OfficialRiskLevel"),
        "UpdateTime": F.col("_as_of"),
    }).drop("_as_of")
    df = df.withColumns({
        "RiskLevelName": L.level_label("RiskLevel"),
        "OfficialRiskLevelName": L.level_label("OfficialRiskLevel"),
        "HigherRiskLevelName": L.level_label("HigherRiskLevel"),
        "Remark": F.lit(None).cast("string"),
        "JSID": F.lit(None).cast("long"),
    })
    return df.na.fill(0, subset=ZERO_FILLED)


def final_rating_quarterly(base: DataFrame, dates: RatingDates, nav: DataFrame,
                           last_state: DataFrame, fund_vol: DataFrame, bench: Column,
                           checkpoint: bool = True) -> DataFrame:
    """Size and volatility flags, X6, unpack, renames, propagation, 41 output columns."""
    # the benchmark sub-query sits in the first stage (over the base), so it runs
    # alongside the series aggregation instead of after it
    df = with_benchmark(base, bench)
    df = df.join(nav_by_quarter(nav, dates), "MainCode", "left")
    df = (df.join(last_state.select("InnerCode", "FundSizeStatus", "SDStatus"), "InnerCode", "left")
            .join(fund_vol, "InnerCode", "left"))
    df = with_flags(df, dates.d1)
    df = df.withColumn("_branch", R.final_rating_branch("InitRiskLevel", "EstablishmentLength", "NetAssetFlag",
                                                       "FundSizeStatus", "SDStatus", "SDFlag"))
    df = df.withColumn("_note", R.final_rating_outcome("_branch", "InitRiskLevel")).drop("_branch")
    df = df.withColumns({
        "SDStatus": F.coalesce(F.col("_note.sd_status"), F.col("SDStatus")),
        "FundSizeStatus": F.coalesce(F.col("_note.size_status"), F.col("FundSizeStatus")),
        "ChangeReason": F.coalesce(F.col("_note.reason"), F.col("ChangeReason")),
        "FinalRiskLevel": F.col("_note.level"),
    }).drop("_note")
    df = df.withColumn("ChangeDirection", R.change_direction("ChangeReason"))
    df = result_names(df)
    df = _once(df.select(*FINAL_COLUMNS, "IsMain"), checkpoint)   # read twice by the propagation
    df = propagate_first(df, "MainCode", ["IsMain", "InnerCode"], PROPAGATED)
    return result_table(df, dates.d1, dates.as_of)


def run_quarterly(t: dict[str, DataFrame], as_of: dt.date, mapping: DataFrame, checkpoint: bool = True,
                  watch: Callable[..., DataFrame] | None = None, fund_vol: DataFrame | None = None) -> DataFrame:
    """Quarterly rating at ``as_of`` from the named input tables.

    ``t`` keys: secumain, fundarchives, fundtype, fundrisklevel, fundtypechangenew,
    mainfinancialindex, last_qrt, unitnvrestored, and zzqz, zzzcf or both as index_quotes. ``fund_vol`` replaces the
    volatility of unitnvrestored (for example by ``returns.volatility_from_states``).
    """
    dates = rating_dates(as_of)
    master = build_master(t["secumain"], t["fundarchives"], t["fundtype"], t["fundrisklevel"],
                          t["fundtypechangenew"], dates.d1, dates.d1)
    base = base_rating_quarterly(master, mapping, dates, checkpoint, watch)
    if fund_vol is None:
        fund_vol = volatility_quarters(t["unitnvrestored"], dates, rate="NVRDailyGrowthRate")
    index_series = t["index_quotes"] if "index_quotes" in t else t["zzqz"].unionByName(t["zzzcf"])
    bench = benchmark_scalar(volatility_quarters(index_series, dates, rate="ChangePCT"))
    nav = t["mainfinancialindex"].join(t["fundarchives"].select("InnerCode", "MainCode"), "InnerCode", "left")
    return final_rating_quarterly(base, dates, nav, t["last_qrt"], fund_vol, bench, checkpoint)
