"""Declared schemas of the rating inputs.

Fixed values: column names and types must equal those of the upstream extracts.
Every field is nullable (the file reader ignores ``nullable=False`` anyway);
required fields are checked explicitly by ``readers.validate``.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


INT, STR, DATE, LONG = T.IntegerType(), T.StringType(), T.DateType(), T.LongType()

# --- fixed values: input table schemas -------------------------------------
FUNDARCHIVES = _schema(
    ("InnerCode", INT), ("MainCode", STR), ("SecurityCode", STR),
    ("ApplyingCodeFront", STR), ("ApplyingCodeBack", STR),
    ("EstablishmentDate", DATE), ("EstablishmentDateII", DATE),
    ("ShareProperties", INT), ("ExpireDate", DATE))

SECUMAIN = _schema(
    ("InnerCode", INT), ("ChiName", STR), ("SecuAbbr", STR),
    ("SecuCategory", INT), ("ListedState", INT))

FUNDTYPE = _schema(
    ("FundTypeCode", INT), ("FundTypeName", STR), ("FNodeCode", INT),
    ("Level", INT), ("IfExecuted", INT))

FUNDRISKLEVEL = _schema(
    ("InnerCode", INT), ("InfoSource", STR), ("RiskLevel", INT),
    ("BeginDate", DATE), ("IfEffected", INT))

FUNDTYPECHANGENEW = _schema(
    ("InnerCode", INT), ("FundType", INT), ("StartDate", DATE))

MAINFINANCIALINDEX = _schema(
    ("InnerCode", INT), ("EndDate", DATE), ("NetAssetsValue", T.DecimalType(18, 3)))

LAST_QRT_QUARTERLY = _schema(
    ("InnerCode", INT), ("FundSizeStatus", INT), ("SDStatus", INT),
    ("HigherRiskLevel", STR), ("HigherRiskLevelName", STR))

LAST_QRT_DAILY = _schema(
    ("EndDate", DATE), ("SecurityCode", STR), ("Number", INT))

UNITNVRESTORED = _schema(
    ("InnerCode", INT), ("TradingDay", DATE),
    ("UnitNVRestored", T.DecimalType(18, 6)), ("NVRDailyGrowthRate", T.DecimalType(18, 8)))

INDEX_QUOTES = _schema(
    ("InnerCode", INT), ("TradingDay", DATE),
    ("ClosePrice", T.DecimalType(18, 4)), ("ChangePCT", T.DecimalType(18, 8)))

FUNDTYPERISKLEVEL = _schema(
    ("FundTypeCode", STR), ("FundTypeName", STR))

RISK_MAPPING = _schema(
    ("FundTypeName1", STR), ("FundTypeName2", STR), ("FundTypeName3", STR), ("RiskLevel", STR))
# ---------------------------------------------------------------------------

# name -> (schema, has header line) of the extract files
EXTRACTS = {
    "fundarchives": (FUNDARCHIVES, False),
    "secumain": (SECUMAIN, False),
    "fundtype": (FUNDTYPE, True),
    "fundrisklevel": (FUNDRISKLEVEL, True),
    "fundtypechangenew": (FUNDTYPECHANGENEW, False),
    "mainfinancialindex": (MAINFINANCIALINDEX, False),
    "last_qrt": (LAST_QRT_QUARTERLY, True),
    "last_batch": (LAST_QRT_DAILY, True),
    "unitnvrestored": (UNITNVRESTORED, True),
    "zzqz": (INDEX_QUOTES, True),
    "zzzcf": (INDEX_QUOTES, True),
    "fundtyperisklevel": (FUNDTYPERISKLEVEL, True),
}

# columns that must be non-null for a row to be usable
REQUIRED = {
    "fundarchives": ["InnerCode"], "secumain": ["InnerCode"], "fundtype": ["FundTypeCode"],
    "fundrisklevel": ["InnerCode"], "fundtypechangenew": ["InnerCode"],
    "mainfinancialindex": ["InnerCode"], "last_qrt": ["InnerCode"],
    "unitnvrestored": ["InnerCode"], "zzqz": ["InnerCode"], "zzzcf": ["InnerCode"],
}
