"""Rating inputs derived from the driver's TPC-H-like TESTDATA tables.

Fund = supplier; NAV facts = orders; the fund return series = lineitem; the two
benchmark indices = daily mean change of the lineitem rows of each line status.
Every derived table is computed by Spark from whole input tables, so its size
grows with the scale factor. The same derivation is written as SQL CTEs in
``riskladder.plans.oracle`` for the DuckDB cross-check; keep the two in step.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskladder.functions import lookups as L
from riskladder.operators.benchmark import INDEX_14110, INDEX_2968
from riskladder.sources.local import local_table

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# name suffixes by s_suppkey % 20 (0 -> empty name, 19 -> null name)
NAME_SUFFIXES = ["", "原油", "商品", "通胀", "黄金", "期货", "上海金", "可转换债券分级", "分级",
                 "可转换债券", "科创", "科技创新", "Reit", "同业存单AAA指数7天", "同业存单",
                 "混合", "债券", "指数", "成长", ""]

# level-3 type codes picked by position in the type history
TYPE_PICKS = [111010, 112010, 112020, 121010, 122010, 123010, 131010, 141010,
              145010, 151010, 171010, 191010, 161010, 199010, 181010]

# (code, name, parent, level, executed): a small fund type tree
TYPE_TREE = [
    (11, "股票基金", 0, 1, 1), (12, "债券基金", 0, 1, 1), (13, "混合基金", 0, 1, 1),
    (14, "QDII基金", 0, 1, 1), (15, "FOF", 0, 1, 1), (16, "其他基金", 0, 1, 0),
    (17, "商品基金", 0, 1, 1), (19, "货币市场基金", 0, 1, 1),
    (1110, "主动投资股票基金", 11, 2, 1), (1120, "指数型股票基金", 11, 2, 1),
    (1210, "主动投资债券基金", 12, 2, 1), (1220, "指数型债券基金", 12, 2, 1),
    (1230, "债券分级子基金", 12, 2, 1), (1310, "主动投资混合基金", 13, 2, 1),
    (1410, "QDII股票基金", 14, 2, 1), (1450, "商品QDII基金", 14, 2, 1),
    (1510, "股票FOF", 15, 2, 1), (1610, "其他基金", 16, 2, 1),
    (1710, "商品基金", 17, 2, 1), (1910, "货币市场基金", 19, 2, 1),
    (111010, "普通股票基金", 1110, 3, 1), (112010, "标准指数股票基金", 1120, 3, 1),
    (112020, "行业指数股票基金", 1120, 3, 1), (121010, "纯债基金", 1210, 3, 1),
    (122010, "可转债指数基金", 1220, 3, 1), (123010, "普通债券分级子基金（进取份额）", 1230, 3, 1),
    (125010, "停用债券类型", 1210, 3, 0), (131010, "偏股混合基金", 1310, 3, 1),
    (141010, "QDII主动投资股票基金", 1410, 3, 1), (145010, "商品QDII基金（除黄金QDII）", 1450, 3, 1),
    (151010, "股票FOF", 1510, 3, 1), (161010, "其他基金", 1610, 3, 1),
    (171010, "黄金基金", 1710, 3, 1), (181010, "分级母基金", 1810, 3, 1),
    (191010, "货币市场基金", 1910, 3, 1), (199010, "未归类基金", 1990, 3, 1),
]

CONVERSION_DAY = dt.date(2000, 11, 15)

# share classes with k % 10 = 5 carry a code from the exchange code lists of the
# special-fund rules (spread over all three lists), so the pipelines exercise them
LISTED_CODES = L.NEEQ_R3 + L.NEEQ_R4 + L.BEIJING_R4


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.col("s_suppkey")


def _code(x: Column) -> Column:
    return F.lpad(x.cast("string"), 6, "0")


def _pick(values: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _days_after(day: dt.date, n: Column) -> Column:
    return F.date_add(F.lit(day), n.cast("int"))


def secumain(spark, sf_dir) -> DataFrame:
    k = _k()
    return load(spark, sf_dir, "supplier").select(
        k.cast("int").alias("InnerCode"),
        F.when(k % 20 == 0, F.lit("")).when(k % 20 == 19, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("s_name"), _pick(NAME_SUFFIXES, k % 20))).alias("ChiName"),
        F.col("s_name").alias("SecuAbbr"),
        F.when(k % 9 == 4, 7).when(k % 9 == 7, 13).otherwise(8).alias("SecuCategory"),
        F.when(k % 11 == 5, 5).when(k % 11 == 3, 3).when(k % 11 == 8, 9).otherwise(1).alias("ListedState"))


def fundarchives(spark, sf_dir) -> DataFrame:
    k = _k()
    pred = k % 10 == 9
    pred_code = F.concat(_code(k - 9), F.lit("J"))
    est = F.when(k % 10 == 0, F.lit(CONVERSION_DAY)).otherwise(
        _days_after(dt.date(1994, 1, 31), (k * 271) % 2750))
    listed_code = _pick(LISTED_CODES, (F.floor(k / 10) * 7) % len(LISTED_CODES))
    return load(spark, sf_dir, "supplier").select(
        k.cast("int").alias("InnerCode"),
        F.when(pred, pred_code).otherwise(_code(k - k % 2)).alias("MainCode"),
        F.when(pred, pred_code).when(k % 10 == 5, listed_code).otherwise(_code(k)).alias("SecurityCode"),
        _code(k).alias("ApplyingCodeFront"),
        F.when(k % 5 == 0, _code(k + 500000)).alias("ApplyingCodeBack"),
        est.alias("EstablishmentDate"),
        F.when(k % 10 == 0, F.lit(CONVERSION_DAY)).when(k % 4 == 1, F.lit(None).cast("date"))
         .otherwise(est).alias("EstablishmentDateII"),
        F.when(k % 3 == 0, 1).when(k % 3 == 1, 2).alias("ShareProperties"),
        F.when(pred & (k % 20 == 19), F.lit(dt.date(2000, 11, 16)))
         .when(pred, F.lit(CONVERSION_DAY))
         .when(k % 13 == 4, F.date_add(est, 2200)).alias("ExpireDate"))


def fundtype(spark, sf_dir=None) -> DataFrame:
    return local_table(spark, TYPE_TREE, "FundTypeCode int, FundTypeName string, FNodeCode int, "
                                         "Level int, IfExecuted int")


def fundtypechangenew(spark, sf_dir) -> DataFrame:
    k = _k()
    sup = load(spark, sf_dir, "supplier")
    older = sup.select(k.cast("int").alias("InnerCode"),
                       _pick(TYPE_PICKS, (k * 7) % 15).alias("FundType"),
                       F.lit(dt.date(1999, 6, 30)).alias("StartDate"))
    newer = sup.select(k.cast("int").alias("InnerCode"),
                       F.when(k % 19 == 7, F.lit(None).cast("int"))
                        .otherwise(_pick(TYPE_PICKS, k % 15)).alias("FundType"),
                       F.when(k % 9 == 2, F.lit(dt.date(2001, 6, 30)))
                        .when(k % 23 == 3, F.lit(dt.date(1999, 6, 30)))
                        .otherwise(F.lit(dt.date(2000, 3, 31))).alias("StartDate"))
    return older.unionByName(newer)


def fundrisklevel(spark, sf_dir) -> DataFrame:
    k = _k()
    sup = load(spark, sf_dir, "supplier")
    older = sup.select(k.cast("int").alias("InnerCode"), F.lit("基金公司").alias("InfoSource"),
                       (k % 5 + 1).cast("int").alias("RiskLevel"),
                       F.lit(dt.date(1998, 1, 1)).alias("BeginDate"), F.lit(1).alias("IfEffected"))
    newer = sup.select(k.cast("int").alias("InnerCode"),
                       F.when(k % 8 == 3, F.lit(L.EXCLUDED_INFO_SOURCE))
                        .when(k % 8 == 5, F.lit(None).cast("string"))
                        .otherwise(F.lit("基金公司")).alias("InfoSource"),
                       ((k + 2) % 6 + 1).cast("int").alias("RiskLevel"),
                       F.when(k % 7 == 2, F.lit(dt.date(2001, 3, 31)))
                        .otherwise(F.lit(dt.date(2000, 6, 30))).alias("BeginDate"),
                       F.when(k % 6 == 4, 0).otherwise(1).alias("IfEffected"))
    return older.unionByName(newer)


def mainfinancialindex(spark, sf_dir) -> DataFrame:
    n_funds = load(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    code = F.col("InnerCode")
    mult = F.when(code % 3 == 0, 4).when(code % 3 == 1, 20).otherwise(60)
    return (load(spark, sf_dir, "orders")
            .withColumn("InnerCode", (F.col("o_custkey") % n_funds).cast("int"))
            .select("InnerCode", F.to_date("o_orderdate").alias("EndDate"),
                    (F.col("o_totalprice").cast("decimal(18,3)") * mult).cast("decimal(18,3)").alias("NetAssetsValue")))


def _pct() -> Column:
    return ((F.col("l_tax") - F.col("l_discount")) * 100).cast("decimal(18,8)")


# one fund in four is a low-volatility fund: its daily changes are a tenth as large
CALM_SHARE = 4
CALM_SCALE = 0.1


def unitnvrestored(spark, sf_dir) -> DataFrame:
    calm = F.col("l_suppkey") % CALM_SHARE == 1
    raw = (F.col("l_tax") - F.col("l_discount")) * 100
    rate = F.when(calm, raw * CALM_SCALE).otherwise(raw).cast("decimal(18,8)")
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("InnerCode"),
        F.to_date("l_shipdate").alias("TradingDay"),
        F.col("l_extendedprice").cast("decimal(18,6)").alias("UnitNVRestored"),
        rate.alias("NVRDailyGrowthRate"))


INDEX_STATUS = {INDEX_2968: "F", INDEX_14110: "O"}


def index_quotes(spark, sf_dir) -> DataFrame:
    """Both benchmark indices in one scan: daily mean change of the lineitem rows of each line status."""
    status = F.col("l_linestatus")
    code = F.lit(None).cast("int")
    for k, v in INDEX_STATUS.items():
        code = F.when(status == v, k).otherwise(code)
    return (load(spark, sf_dir, "lineitem").filter(status.isin(*INDEX_STATUS.values()))
            .groupBy(status, F.to_date("l_shipdate").alias("TradingDay"))
            .agg(F.avg(_pct().cast("double")).cast("decimal(18,8)").alias("ChangePCT"))
            .select(code.alias("InnerCode"), "TradingDay", F.lit(None).cast("decimal(18,4)").alias("ClosePrice"), "ChangePCT"))


def zzqz(spark, sf_dir) -> DataFrame:
    return index_quotes(spark, sf_dir).filter(F.col("InnerCode") == INDEX_2968)


def zzzcf(spark, sf_dir) -> DataFrame:
    return index_quotes(spark, sf_dir).filter(F.col("InnerCode") == INDEX_14110)


def type_code_rows() -> list[tuple[str, str]]:
    """Made-up type codes: distinct level-3 names numbered in table order; every third name
    comes again under a larger code, so lookups meet repeated keys."""
    names = list(dict.fromkeys(r[2] for r in L.BASIC_RISK_LEVEL))
    return [(str(i + 1), n) for i, n in enumerate(names)] + [(str(i + 101), n) for i, n in enumerate(names) if i % 3 == 0]


def fundtyperisklevel(spark) -> DataFrame:
    return local_table(spark, type_code_rows(), "FundTypeCode string, FundTypeName string")


def last_qrt(spark, sf_dir) -> DataFrame:
    k = _k()
    return load(spark, sf_dir, "supplier").select(
        k.cast("int").alias("InnerCode"),
        # moduli independent of the NAV multiplier (% 3) and the calm funds (% 4)
        F.when(k % 5 != 4, (k % 5 % 2).cast("int")).alias("FundSizeStatus"),
        F.when(k % 7 >= 3, F.when(k % 7 != 6, 1)).otherwise(0).cast("int").alias("SDStatus"),
        F.lit(None).cast("string").alias("HigherRiskLevel"),
        F.lit(None).cast("string").alias("HigherRiskLevelName"))


def last_batch(spark, sf_dir) -> DataFrame:
    k = _k()
    return load(spark, sf_dir, "supplier").select(
        F.when(k % 4 == 3, F.lit(dt.date(2000, 9, 30))).otherwise(F.lit(dt.date(2000, 12, 31))).alias("EndDate"),
        F.when(k % 17 == 5, F.lit(None).cast("string")).otherwise(_code(k)).alias("SecurityCode"),
        F.when(k % 4 == 1, 1).when(k % 4 == 3, 3).otherwise(2).alias("Number"))


def fund_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "secumain": secumain(spark, sf_dir), "fundarchives": fundarchives(spark, sf_dir),
        "fundtype": fundtype(spark), "fundrisklevel": fundrisklevel(spark, sf_dir),
        "fundtypechangenew": fundtypechangenew(spark, sf_dir),
        "mainfinancialindex": mainfinancialindex(spark, sf_dir),
        "last_qrt": last_qrt(spark, sf_dir), "unitnvrestored": unitnvrestored(spark, sf_dir),
        "zzqz": zzqz(spark, sf_dir), "zzzcf": zzzcf(spark, sf_dir), "index_quotes": index_quotes(spark, sf_dir),
        "last_batch": last_batch(spark, sf_dir), "fundtyperisklevel": fundtyperisklevel(spark),
    }
