"""Master table: one row per listed fund share class with its current type path
and latest official rating (as of the rating date)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskladder.functions import lookups as L
from riskladder.functions.rules import level_code
from riskladder.operators.asof import effective_at, latest_at_dates, latest_per_key
from riskladder.operators.hierarchy import attach_type_path

FUND_CATEGORIES = (8, 13)          # fixed values: security categories that are funds
LISTED_STATES = (1, 3, 9)          # fixed values: listing states kept


def listed_funds(secumain: DataFrame) -> DataFrame:
    """Securities that are funds and listed (F1)."""
    return secumain.filter(F.col("SecuCategory").isin(*FUND_CATEGORIES)
                           & F.col("ListedState").isin(*LISTED_STATES))


def current_type(type_history: DataFrame, as_of: dt.date | None) -> DataFrame:
    """Newest type per fund (on/before ``as_of``; None = no date cut). A fund whose
    newest type is an 18xx code drops out; it does not fall back to an older type."""
    hist = type_history if as_of is None else effective_at(type_history, "StartDate", as_of)
    latest = latest_per_key(hist, "InnerCode", ["StartDate"], ["FundType"])
    return (latest.filter(~F.col("FundType").cast("string").startswith("18"))
                  .select("InnerCode", F.col("FundType").alias("FundTypeCode3")))


def official_rating(ratings: DataFrame, as_of: dt.date) -> DataFrame:
    """Latest effective official rating per fund -> InnerCode, OfficialRiskLevel."""
    eff = (effective_at(ratings, "BeginDate", as_of)
           .filter((F.col("IfEffected") == 1) & (F.col("InfoSource") != L.EXCLUDED_INFO_SOURCE)))
    latest = latest_per_key(eff, "InnerCode", ["BeginDate"], ["RiskLevel"])
    return latest.select("InnerCode", level_code("RiskLevel").alias("OfficialRiskLevel"))


def build_master(secumain: DataFrame, fundarchives: DataFrame, fundtype: DataFrame,
                 fundrisklevel: DataFrame, fundtypechangenew: DataFrame,
                 d1: dt.date, type_as_of: dt.date | None) -> DataFrame:
    """Funds (category, listing) -> archive -> current type (inner) -> type path -> official level.

    ``d1`` cuts the official ratings; ``type_as_of`` cuts the type history (the
    quarterly job passes D1, the daily job its run date); ``None`` takes the
    newest type regardless of its start date.
    """
    funds = (listed_funds(secumain)
             .join(fundarchives, "InnerCode", "left")
             .join(current_type(fundtypechangenew, type_as_of), "InnerCode", "inner"))
    return attach_type_path(funds, fundtype).join(official_rating(fundrisklevel, d1), "InnerCode", "left")


def master_history(secumain: DataFrame, fundarchives: DataFrame, fundtype: DataFrame, fundrisklevel: DataFrame,
                   fundtypechangenew: DataFrame, dates: list[dt.date]) -> DataFrame:
    """``build_master`` at every date (types and official ratings cut there) in one pass, the date in column D1."""
    types = latest_at_dates(fundtypechangenew, "InnerCode", "StartDate", dates, ["StartDate"], ["FundType"], "D1")
    types = (types.filter(~F.col("FundType").cast("string").startswith("18"))
             .select("InnerCode", "D1", F.col("FundType").alias("FundTypeCode3")))
    official = fundrisklevel.filter((F.col("IfEffected") == 1) & (F.col("InfoSource") != L.EXCLUDED_INFO_SOURCE))
    official = latest_at_dates(official, "InnerCode", "BeginDate", dates, ["BeginDate"], ["RiskLevel"], "D1")
    official = official.select("InnerCode", "D1", level_code("RiskLevel").alias("OfficialRiskLevel"))
    funds = listed_funds(secumain).join(fundarchives, "InnerCode", "left").join(types, "InnerCode", "inner")
    return attach_type_path(funds, fundtype).join(official, ["InnerCode", "D1"], "left")
