"""Daily pre-rating of share classes that are not in the newest published batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskladder.functions import lookups as L
from riskladder.functions import rules as R
from riskladder.functions.calendar import rating_dates
from riskladder.operators.asof import latest_batch
from riskladder.operators.joins import left_lookup, one_per_key
from riskladder.plans.master import build_master
from riskladder.plans.quarterly import NAME_KEYS, fof_names

# fixed values: output columns
DAILY_COLUMNS = ["InnerCode", "EndDate", "FundTypeCode", "RLDivisionMode", "InitialRiskLevel",
                 "InitialRiskLevelDesc", "BasicRiskLevel", "BasicRiskLevelDesc", "SpecialType",
                 "Remark", "UpdateTime", "JSID"]


def base_rating_daily(master: DataFrame, mapping: DataFrame, type_codes: DataFrame,
                      last_batch: DataFrame, as_of: dt.date, watch: Callable[..., DataFrame] | None = None) -> DataFrame:
    """Anti-join against the newest batch, FOF renames, lookup, X1, X3, type code, labels."""
    newest = latest_batch(last_batch, "EndDate", "Number").select("SecurityCode")
    df = master.join(newest, "SecurityCode", "left_anti")
    df = fof_names(df)
    df = left_lookup(df, mapping, NAME_KEYS)
    df = R.apply_base_rule(df, "InitialRiskLevel", "BasicRiskLevel")
    df = (df.withColumn("_x3", R.special_rule_daily("ChiName", "SecurityCode", "BasicRiskLevel"))
            .withColumns({"BasicRiskLevel": F.col("_x3.level"), "SpecialType": F.col("_x3.special")})
            .drop("_x3"))
    codes = one_per_key(type_codes.withColumn("_n", F.col("FundTypeCode").try_cast("long")), ["FundTypeName"], ["_n", "FundTypeCode"], watch)
    codes = codes.select("FundTypeCode", F.col("FundTypeName").alias("_type_name"))
    df = df.join(codes, df["FundTypeName3"] == codes["_type_name"], "left")
    return df.withColumns({
        "InitialRiskLevelDesc": L.level_label("InitialRiskLevel"),
        "BasicRiskLevelDesc": L.level_label("BasicRiskLevel"),
        "EndDate": F.date_sub(F.lit(as_of), 1),
        "RLDivisionMode": F.lit(2),
        "Remark": F.lit(None).cast("string"),
        "JSID": F.lit(None).cast("long"),
        "FundTypeCode": F.col("FundTypeCode").cast("long"),
        "UpdateTime": F.lit(as_of),
    }).select(*DAILY_COLUMNS)


def run_daily(t: dict[str, DataFrame], as_of: dt.date, mapping: DataFrame, type_codes: DataFrame,
              cut_type_history: bool = True, watch: Callable[..., DataFrame] | None = None) -> DataFrame:
    """Daily rating at ``as_of``. ``t`` keys: secumain, fundarchives, fundtype,
    fundrisklevel, fundtypechangenew, last_batch.

    ``cut_type_history=False`` takes the newest type even if it starts after the
    rating date (the behaviour of the original daily job).
    """
    dates = rating_dates(as_of)
    master = build_master(t["secumain"], t["fundarchives"], t["fundtype"], t["fundrisklevel"],
                          t["fundtypechangenew"], dates.d1, as_of if cut_type_history else None)
    return base_rating_daily(master, mapping, type_codes, t["last_batch"], as_of, watch)
