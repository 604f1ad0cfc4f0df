"""Fixed lookup values of the rating method and their DataFrame forms.

Everything between the ``fixed values`` markers must equal the rating method's
published tables for results to be right; it is kept as plain text in the
original order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskladder.sources.local import local_table

# --- fixed values: basic risk level by (type level 1, level 2, level 3) -----
BASIC_RISK_LEVEL = [
    ("股票基金", "主动投资股票基金", "普通股票基金", "R3"),
    ("股票基金", "主动投资股票基金", "港股通股票基金", "R3"),
    ("股票基金", "指数型股票基金", "标准指数股票基金", "R3"),
    ("股票基金", "指数型股票基金", "增强指数股票基金", "R3"),
    ("股票基金", "股票分级子基金", "股票分级子基金（进取份额）", "R5"),
    ("股票基金", "股票分级子基金", "股票分级子基金（优先份额）", "R3"),
    ("混合基金", "主动投资混合基金", "偏股混合基金", "R3"),
    ("混合基金", "主动投资混合基金", "灵活配置混合基金", "R3"),
    ("混合基金", "主动投资混合基金", "偏债混合基金", "R3"),
    ("混合基金", "主动投资混合基金", "港股通混合基金", "R3"),
    ("混合基金", "指数型混合基金", "标准指数混合基金", "R3"),
    ("混合基金", "指数型混合基金", "增强指数混合基金", "R3"),
    ("混合基金", "混合分级子基金", "混合分级子基金（进取份额）", "R5"),
    ("混合基金", "混合分级子基金", "混合分级子基金（优先份额）", "R3"),
    ("混合基金", "避险基金", "避险基金", "R3"),
    ("债券基金", "主动投资债券基金", "纯债基金", "R2"),
    ("债券基金", "主动投资债券基金", "普通债券基金", "R2"),
    ("债券基金", "主动投资债券基金", "可转债基金", "R3"),
    ("债券基金", "指数型债券基金", "标准指数债券基金", "R2"),
    ("债券基金", "指数型债券基金", "增强指数债券基金", "R2"),
    ("债券基金", "指数型债券基金", "可转债指数基金", "R3"),
    ("债券基金", "债券分级子基金", "普通债券分级子基金（进取份额）", "R4"),
    ("债券基金", "债券分级子基金", "普通债券分级子基金（优先份额）", "R3"),
    ("债券基金", "债券分级子基金", "可转债分级子基金（进取份额）", "R5"),
    ("债券基金", "债券分级子基金", "可转债分级子基金（优先份额）", "R3"),
    ("债券基金", "短期理财债券基金", "短期理财债券基金", "R1"),
    ("货币市场基金", "货币市场基金", "货币市场基金", "R1"),
    ("QDII基金", "QDII股票基金", "QDII主动投资股票基金", "R3"),
    ("QDII基金", "QDII股票基金", "QDII指数投资股票基金", "R3"),
    ("QDII基金", "QDII混合基金", "QDII混合基金", "R3"),
    ("QDII基金", "QDII债券基金", "QDII主动投资债券基金", "R2"),
    ("QDII基金", "QDII分级子基金", "QDII分级子基金（进取份额）", "R5"),
    ("QDII基金", "QDII分级子基金", "QDII分级子基金（优先份额）", "R3"),
    ("QDII基金", "其他QDII基金", "其他QDII基金", "R3"),
    ("QDII基金", "商品QDII基金", "商品QDII基金（除黄金QDII）", "R5"),
    ("QDII基金", "商品QDII基金", "黄金QDII基金", "R3"),
    ("FOF", "股票FOF", "股票FOF", "R3"),
    ("FOF", "债券FOF", "债券FOF", "R2"),
    ("FOF", "货币FOF", "货币FOF", "R1"),
    ("FOF", "混合FOF", "混合FOF", "R3"),
    ("FOF", "其他FOF", "其他FOF", "R3"),
    ("封闭式基金", "封闭式股票基金", "封闭式股票基金", "R3"),
    ("封闭式基金", "封闭式混合基金", "封闭式混合基金", "R3"),
    ("封闭式基金", "封闭式债券基金", "封闭式债券基金", "R2"),
    ("商品基金", "商品基金", "商品基金（除黄金基金）", "R5"),
    ("商品基金", "商品基金", "黄金基金", "R3"),
    ("其他基金", "其他基金", "其他基金", "R3"),
]

# --- fixed values: security-code lists of the special-fund rules -----------
# NEEQ funds rated R3 (quarterly and daily)
NEEQ_R3 = [
    "009697", "009698", "009693", "009688", "009681", "009682", "009683", "009684",
    "009695", "009696", "009867", "009868", "010887", "010888", "012107", "012108",
    "011886", "011887", "011011", "010646", "010647", "012850", "012851", "012194",
    "012193", "910005",
]
# NEEQ funds rated R4 in the daily rule (special type 3)
NEEQ_R4 = ["011783", "011530", "910006", "910009", "011790", "013867", "013868"]
# Beijing exchange funds rated R4 in the daily rule (special type 4)
BEIJING_R4 = [
    "014269", "014270", "014271", "014272", "014273", "014274", "014275", "014276",
    "014277", "014278", "014279", "014280", "014283", "014294", "014062", "014063",
    "014185", "014186", "014232", "014233", "014736", "014737",
]
# the quarterly rule rates the union of both R4 lists R4
QUARTERLY_R4 = NEEQ_R4 + BEIJING_R4

# --- fixed values: level labels --------------------------------------------
LEVEL_LABELS = [("R1", "低"), ("R2", "较低"), ("R3", "中等"), ("R4", "较高"), ("R5", "高")]
UNKNOWN_LABEL = "未知"

# --- fixed values: texts used by the rules ---------------------------------
EXCLUDED_INFO_SOURCE = "聚源规则定义"
CONVERSION_REMARK = "由%s转型而来"
REASON_SIZE_UP = "规模上升"
REASON_SIZE_DOWN = "规模下降"
REASON_SD_UP = "波动率上升"
REASON_SD_DOWN = "波动率下降"
# ---------------------------------------------------------------------------

MAPPING_DDL = "FundTypeName1 string, FundTypeName2 string, FundTypeName3 string, RiskLevel string"


def risk_mapping(spark: SparkSession, level_column: str = "RiskLevel") -> DataFrame:
    """The 47-row basic-level table (a local relation of known size)."""
    df = local_table(spark, BASIC_RISK_LEVEL, MAPPING_DDL)
    return df.withColumnRenamed("RiskLevel", level_column) if level_column != "RiskLevel" else df


def read_risk_mapping(spark: SparkSession, path: str, level_column: str = "RiskLevel") -> DataFrame:
    """A replacement basic-level table from a file.

    ``.csv``: header ``FundTypeName1,FundTypeName2,FundTypeName3,RiskLevel``, read by
    Spark. ``.yaml`` / ``.yml``: the original configuration layout
    (``fund_risk_estimate.basic_risk_level``: a list of 4-string rows), parsed on the
    driver - it is a small, hand-edited file - and turned into a sized local table.
    """
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:                     # optional dependency
            raise RuntimeError("reading a YAML mapping needs PyYAML; use a CSV mapping") from e
        with open(path, encoding="utf-8") as f:
            rows = yaml.safe_load(f)["fund_risk_estimate"]["basic_risk_level"]
        df = local_table(spark, [tuple(str(v) for v in r) for r in rows], MAPPING_DDL)
    else:
        df = spark.read.option("header", True).option("enforceSchema", False).schema(MAPPING_DDL).csv(path)
    return df.withColumnRenamed("RiskLevel", level_column) if level_column != "RiskLevel" else df


def level_label(level) -> "F.Column":
    """R1..R5 -> label; null -> 未知; anything else -> null."""
    c = F.col(level) if isinstance(level, str) else level
    expr = F.when(c.isNull(), F.lit(UNKNOWN_LABEL))
    for code, label in LEVEL_LABELS:
        expr = expr.when(c == code, F.lit(label))
    return expr
