"""DuckDB SQL twins of the registered queries (the correctness oracle).

The query shapes differ from the Spark code: window functions where Spark uses
aggregates, four separate window CTEs joined where Spark makes one pass, CASE
chains where Spark uses branch tables, and the stand-in inputs re-derived as CTEs.
Fixed values (code lists, mapping, dates, index keys) are imported from the package and so
are not checked here; the unit tests hold them against literal values.
"""

from __future__ import annotations

import datetime as dt

from riskladder.functions import lookups as L
from riskladder.functions.calendar import QUARTER_LABELS, WEEK_ANCHOR, rating_dates
from riskladder.operators.benchmark import INDEX_14110, INDEX_2968
from riskladder.plans import catalog as Q
from riskladder.sources import standins as S

D = Q.DATES


def d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def s(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, str):
        return "'" + x.replace("'", "''") + "'"
    return str(x)


def lst(values) -> str:
    return "[" + ", ".join(s(v) for v in values) + "]"


def values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(s(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def code6(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), 6, '0')"


def case(branches, idx, default) -> str:
    parts = [f"WHEN {c} THEN {out[idx] if out[idx] is not None else 'NULL'}" for c, out in branches]
    return "CASE " + " ".join(parts) + f" ELSE {default} END"


def has(name, *words) -> str:
    return "(" + " OR ".join(f"contains({name}, {s(w)})" for w in words) + ")"


# ---------------------------------------------------------------------------
# rules as CASE chains
# ---------------------------------------------------------------------------
def x1(name, c1, c2, level, share) -> dict[str, str]:
    """-> level / n1 / n2 / n3 expressions (names NULL where unchanged)."""
    def fx(t):
        return tuple(s(v) for v in t)
    keep = (level, None, None, None)
    qdii = f"({c1} = 14 AND {c2} = 1450)"
    cb, gr = f"contains({name}, '可转换债券')", f"contains({name}, '分级')"
    br = [
        (f"{c1} = 15", ("'R3'", None, None, None)),
        (f"{qdii} AND {has(name, '原油', '商品', '通胀')}", fx(("R5", "QDII基金", "商品QDII基金", "商品QDII基金（除黄金QDII）"))),
        (f"{qdii} AND contains({name}, '黄金')", fx(("R3", "QDII基金", "商品QDII基金", "黄金QDII基金"))),
        (qdii, keep),
        (f"{c1} = 17 AND contains({name}, '期货')", fx(("R5", "商品基金", "商品基金", "商品基金（除黄金基金）"))),
        (f"{c1} = 17 AND {has(name, '黄金', '上海金')}", fx(("R3", "商品基金", "商品基金", "黄金基金"))),
        (f"{c1} = 17", keep),
        (f"{c1} = 12 AND {cb} AND {gr} AND {share} = 1", fx(("R3", "债券基金", "债券分级子基金", "可转债分级子基金（优先份额）"))),
        (f"{c1} = 12 AND {cb} AND {gr} AND {share} = 2", fx(("R5", "债券基金", "债券分级子基金", "可转债分级子基金（进取份额）"))),
        (f"{c1} = 12 AND NOT {cb} AND {gr} AND {share} = 1", fx(("R3", "债券基金", "债券分级子基金", "普通债券分级子基金（优先份额）"))),
        (f"{c1} = 12 AND NOT {cb} AND {gr} AND {share} = 2", fx(("R4", "债券基金", "债券分级子基金", "普通债券分级子基金（进取份额）"))),
        (f"{c1} = 12 AND {c2} = 1220 AND {cb}", fx(("R3", "债券基金", "指数型债券基金", "可转债指数基金"))),
    ]
    return {k: case(br, i, level if i == 0 else "NULL") for i, k in enumerate(["level", "n1", "n2", "n3"])}


def x2(name, code, level) -> str:
    return (f"CASE WHEN {name} IS NULL OR {name} = '' THEN {level} "
            f"WHEN {has(name, '科创', '科技创新')} THEN 'R4' "
            f"WHEN contains(upper({name}), 'REIT') THEN 'R4' "
            f"WHEN {code} IN ({', '.join(map(s, L.NEEQ_R3))}) THEN 'R3' "
            f"WHEN {code} IN ({', '.join(map(s, L.QUARTERLY_R4))}) THEN 'R4' "
            f"ELSE {level} END")


def x3(name, code, level) -> dict[str, str]:
    br = [
        (f"{name} IS NULL OR {name} = ''", (level, "NULL")),
        (has(name, "科创", "科技创新"), ("'R4'", "1")),
        (f"contains(upper({name}), 'REIT')", ("'R4'", "2")),
        (f"{code} IN ({', '.join(map(s, L.NEEQ_R3))})", ("'R3'", "3")),
        (f"{code} IN ({', '.join(map(s, L.NEEQ_R4))})", ("'R4'", "3")),
        (f"{code} IN ({', '.join(map(s, L.BEIJING_R4))})", ("'R4'", "4")),
        (f"contains({name}, '同业存单AAA指数7天')", ("'R1'", "NULL")),
        (f"contains({name}, '同业存单')", ("'R2'", "NULL")),
    ]
    return {"level": case(br, 0, level), "special": f"CAST({case(br, 1, 'NULL')} AS BIGINT)"}


def up(level) -> str:
    digit = f"TRY_CAST(right({level}, 1) AS INTEGER)"
    return f"(CASE WHEN {digit} IS NOT NULL THEN 'R' || CAST(least({digit} + 1, 5) AS VARCHAR) END)"


def x6(lv, m, nf, S_, V, sf) -> dict[str, str]:
    mid = f"({lv} IN ('R2', 'R3', 'R4'))"
    u = up(lv)
    revert = f"({nf} = 2 AND {mid} AND {sf} = 2)"
    middle = f"({m} >= 18 AND {m} <= 42)"
    old = f"({m} > 42)"
    s0v0 = f"({S_} = 0 AND {V} = 0)"
    br = [
        (f"{m} < 18", (lv, None, None, None)),
        (f"{middle} AND {S_} = 1 AND {nf} = 2", (lv, "'规模上升'", "0", "0")),
        (f"{middle} AND {S_} = 1", (u, None, None, None)),
        (f"{middle} AND {S_} = 0 AND {nf} = 1", (u, "'规模下降'", "1", "0")),
        (middle, (lv, None, None, None)),
        (f"{old} AND {S_} = 1 AND {V} = 1 AND {revert}", (lv, "'规模上升,波动率下降'", "0", "0")),
        (f"{old} AND {S_} = 1 AND {V} = 0 AND {revert}", (lv, "'规模上升'", "0", "0")),
        (f"{old} AND {S_} = 0 AND {V} = 1 AND {revert}", (lv, "'波动率下降'", "0", "0")),
        (f"{old} AND (({S_} = 1 AND {V} = 1) OR ({S_} = 1 AND {V} = 0) OR ({S_} = 0 AND {V} = 1))", (u, None, None, None)),
        (f"{old} AND {s0v0} AND {nf} = 1 AND {mid} AND {sf} = 1", (u, "'规模下降,波动率上升'", "1", "1")),
        (f"{old} AND {s0v0} AND {nf} = 1", (u, "'规模下降'", "1", "0")),
        (f"{old} AND {s0v0} AND {mid} AND {sf} = 1", (u, "'波动率上升'", "0", "1")),
    ]
    return {"level": case(br, 0, lv), "reason": case(br, 1, "NULL"),
            "size": f"CAST({case(br, 2, 'NULL')} AS INTEGER)", "sd": f"CAST({case(br, 3, 'NULL')} AS INTEGER)"}


def direction(reason) -> str:
    return (f"CASE WHEN contains({reason}, '规模上升') THEN -1 WHEN contains({reason}, '波动率下降') THEN -1 "
            f"WHEN contains({reason}, '规模下降') THEN 1 WHEN contains({reason}, '波动率上升') THEN 1 ELSE 0 END")


def label(level) -> str:
    whens = " ".join(f"WHEN {level} = {s(c)} THEN {s(n)}" for c, n in L.LEVEL_LABELS)
    return f"CASE WHEN {level} IS NULL THEN {s(L.UNKNOWN_LABEL)} {whens} END"


def level_code(n) -> str:
    return "CASE " + " ".join(f"WHEN {n} = {k} THEN 'R{k}'" for k in range(1, 6)) + " END"


def size_flag(f, t, sc, l) -> str:
    return (f"CASE WHEN {l} < 1000 THEN 1 WHEN {l} < 5000 AND {sc} < 5000 AND {t} < 5000 AND {f} < 5000 THEN 1 "
            f"WHEN {l} > 5000 AND {sc} > 5000 AND {t} > 5000 AND {f} > 5000 THEN 2 ELSE 0 END")


def months_between(a: dt.date, b: str) -> str:
    """Spark's months_between(a, b) for dates, written out."""
    A = d(a)
    whole = f"((year({A}) - year({b})) * 12 + month({A}) - month({b}))"
    return (f"(CASE WHEN day({A}) = day({b}) OR ({A} = last_day({A}) AND {b} = last_day({b})) "
            f"THEN CAST({whole} AS DOUBLE) "
            f"ELSE round(CAST({whole} AS DOUBLE) + CAST(day({A}) - day({b}) AS DOUBLE) / 31, 8) END)")


def week(day) -> str:
    return f"CAST(floor(date_diff('day', {d(WEEK_ANCHOR)}, {day}) / 7) AS BIGINT)"


def factor(rate) -> str:
    return f"CAST(1 + {rate} * 0.01 AS DOUBLE)"


def compound(expr) -> str:
    return f"CAST(CAST(product({expr}) - 1 AS DECIMAL(28,12)) AS DECIMAL(18,6))"


def sample_sd(r) -> str:
    """Sample deviation of DECIMAL(18,6) values from whole-number sums."""
    x = f"CAST({r} * 1000000 AS HUGEINT)"
    return (f"CASE WHEN count({r}) > 1 THEN sqrt(CAST(count({r}) * sum({x} * {x}) - sum({x}) * sum({x}) AS DOUBLE) / CAST(1e12 AS DOUBLE) "
            f"/ CAST(count({r}) * (count({r}) - 1) AS DOUBLE)) END")


def in_win(day, lo, hi) -> str:
    return f"({day} > {d(lo)} AND {day} <= {d(hi)})"


# ---------------------------------------------------------------------------
# stand-in inputs (mirror of riskladder.sources.standins)
# ---------------------------------------------------------------------------
PCT = "CAST((l_tax - l_discount) * 100 AS DECIMAL(18,8))"
CONV = d(S.CONVERSION_DAY)

ADAPTER = {
    "secumain": f"""SELECT CAST(s_suppkey AS INTEGER) AS InnerCode,
        CASE WHEN s_suppkey % 20 = 0 THEN '' WHEN s_suppkey % 20 = 19 THEN NULL
             ELSE s_name || {lst(S.NAME_SUFFIXES)}[s_suppkey % 20 + 1] END AS ChiName,
        s_name AS SecuAbbr,
        CASE WHEN s_suppkey % 9 = 4 THEN 7 WHEN s_suppkey % 9 = 7 THEN 13 ELSE 8 END AS SecuCategory,
        CASE WHEN s_suppkey % 11 = 5 THEN 5 WHEN s_suppkey % 11 = 3 THEN 3 WHEN s_suppkey % 11 = 8 THEN 9 ELSE 1 END AS ListedState
      FROM supplier""",
    "fa0": f"""SELECT s_suppkey AS k, CASE WHEN s_suppkey % 10 = 0 THEN {CONV}
        ELSE {d(dt.date(1994, 1, 31))} + CAST((s_suppkey * 271) % 2750 AS INTEGER) END AS est FROM supplier""",
    "fundarchives": f"""SELECT CAST(k AS INTEGER) AS InnerCode,
        CASE WHEN k % 10 = 9 THEN {code6('k - 9')} || 'J' ELSE {code6('k - k % 2')} END AS MainCode,
        CASE WHEN k % 10 = 9 THEN {code6('k - 9')} || 'J'
             WHEN k % 10 = 5 THEN {lst(S.LISTED_CODES)}[((k // 10) * 7) % {len(S.LISTED_CODES)} + 1]
             ELSE {code6('k')} END AS SecurityCode,
        {code6('k')} AS ApplyingCodeFront,
        CASE WHEN k % 5 = 0 THEN {code6('k + 500000')} END AS ApplyingCodeBack,
        est AS EstablishmentDate,
        CASE WHEN k % 10 = 0 THEN {CONV} WHEN k % 4 = 1 THEN NULL ELSE est END AS EstablishmentDateII,
        CASE WHEN k % 3 = 0 THEN 1 WHEN k % 3 = 1 THEN 2 END AS ShareProperties,
        CASE WHEN k % 10 = 9 AND k % 20 = 19 THEN {d(dt.date(2000, 11, 16))} WHEN k % 10 = 9 THEN {CONV}
             WHEN k % 13 = 4 THEN est + 2200 END AS ExpireDate
      FROM fa0""",
    "fundtype": f"SELECT * FROM {values(S.TYPE_TREE, ['FundTypeCode', 'FundTypeName', 'FNodeCode', 'Level', 'IfExecuted'])}",
    "fundtypechangenew": f"""SELECT CAST(s_suppkey AS INTEGER) AS InnerCode,
          {lst(S.TYPE_PICKS)}[(s_suppkey * 7) % 15 + 1] AS FundType, {d(dt.date(1999, 6, 30))} AS StartDate FROM supplier
      UNION ALL
      SELECT CAST(s_suppkey AS INTEGER),
          CASE WHEN s_suppkey % 19 = 7 THEN NULL ELSE {lst(S.TYPE_PICKS)}[s_suppkey % 15 + 1] END,
          CASE WHEN s_suppkey % 9 = 2 THEN {d(dt.date(2001, 6, 30))} WHEN s_suppkey % 23 = 3 THEN {d(dt.date(1999, 6, 30))}
               ELSE {d(dt.date(2000, 3, 31))} END FROM supplier""",
    "fundrisklevel": f"""SELECT CAST(s_suppkey AS INTEGER) AS InnerCode, '基金公司' AS InfoSource,
          CAST(s_suppkey % 5 + 1 AS INTEGER) AS RiskLevel, {d(dt.date(1998, 1, 1))} AS BeginDate, 1 AS IfEffected FROM supplier
      UNION ALL
      SELECT CAST(s_suppkey AS INTEGER),
          CASE WHEN s_suppkey % 8 = 3 THEN {s(L.EXCLUDED_INFO_SOURCE)} WHEN s_suppkey % 8 = 5 THEN NULL ELSE '基金公司' END,
          CAST((s_suppkey + 2) % 6 + 1 AS INTEGER),
          CASE WHEN s_suppkey % 7 = 2 THEN {d(dt.date(2001, 3, 31))} ELSE {d(dt.date(2000, 6, 30))} END,
          CASE WHEN s_suppkey % 6 = 4 THEN 0 ELSE 1 END FROM supplier""",
    "nfunds": "SELECT count(*) AS n FROM supplier",
    "mainfinancialindex": """SELECT CAST(o_custkey % (SELECT n FROM nfunds) AS INTEGER) AS InnerCode,
        CAST(o_orderdate AS DATE) AS EndDate,
        CAST(CAST(o_totalprice AS DECIMAL(18,3)) * CASE (o_custkey % (SELECT n FROM nfunds)) % 3
             WHEN 0 THEN 4 WHEN 1 THEN 20 ELSE 60 END AS DECIMAL(18,3)) AS NetAssetsValue
      FROM orders""",
    "unitnvrestored": f"""SELECT CAST(l_suppkey AS INTEGER) AS InnerCode, CAST(l_shipdate AS DATE) AS TradingDay,
        CAST(CASE WHEN l_suppkey % {S.CALM_SHARE} = 1 THEN (l_tax - l_discount) * 100 * CAST({S.CALM_SCALE} AS DOUBLE)
                  ELSE (l_tax - l_discount) * 100 END AS DECIMAL(18,8)) AS NVRDailyGrowthRate FROM lineitem""",
    "zzqz": f"""SELECT {INDEX_2968} AS InnerCode, CAST(l_shipdate AS DATE) AS TradingDay,
        CAST(NULL AS DECIMAL(18,4)) AS ClosePrice, CAST(avg(CAST({PCT} AS DOUBLE)) AS DECIMAL(18,8)) AS ChangePCT
      FROM lineitem WHERE l_linestatus = 'F' GROUP BY CAST(l_shipdate AS DATE)""",
    "zzzcf": f"""SELECT {INDEX_14110} AS InnerCode, CAST(l_shipdate AS DATE) AS TradingDay,
        CAST(NULL AS DECIMAL(18,4)) AS ClosePrice, CAST(avg(CAST({PCT} AS DOUBLE)) AS DECIMAL(18,8)) AS ChangePCT
      FROM lineitem WHERE l_linestatus = 'O' GROUP BY CAST(l_shipdate AS DATE)""",
    "last_qrt": """SELECT CAST(s_suppkey AS INTEGER) AS InnerCode,
        CASE WHEN s_suppkey % 5 <> 4 THEN CAST(s_suppkey % 5 % 2 AS INTEGER) END AS FundSizeStatus,
        CAST(CASE WHEN s_suppkey % 7 = 6 THEN NULL WHEN s_suppkey % 7 >= 3 THEN 1 ELSE 0 END AS INTEGER) AS SDStatus
      FROM supplier""",
    "last_batch": f"""SELECT CASE WHEN s_suppkey % 4 = 3 THEN {d(dt.date(2000, 9, 30))} ELSE {d(dt.date(2000, 12, 31))} END AS EndDate,
        CASE WHEN s_suppkey % 17 = 5 THEN NULL ELSE {code6('s_suppkey')} END AS SecurityCode,
        CASE WHEN s_suppkey % 4 = 1 THEN 1 WHEN s_suppkey % 4 = 3 THEN 3 ELSE 2 END AS Number FROM supplier""",
    "risk_mapping": f"SELECT * FROM {values(L.BASIC_RISK_LEVEL, ['FundTypeName1', 'FundTypeName2', 'FundTypeName3', 'RiskLevel'])}",
}


def with_ctes(ctes: dict[str, str], final: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + final


# ---------------------------------------------------------------------------
# volatility, written as the four-window definition (no one-pass trick)
# ---------------------------------------------------------------------------
def vol_ctes(src: str, rate: str, prefix: str, D=D) -> dict[str, str]:
    out = {}
    for lab, lo, hi in D.vol_windows:
        out[f"{prefix}w{lab}"] = (f"SELECT InnerCode, {sample_sd('r')} AS {lab}QrtSD FROM ("
                                  f"SELECT InnerCode, {week('TradingDay')} AS wk, {compound(factor(rate))} AS r "
                                  f"FROM {src} WHERE {in_win('TradingDay', lo, hi)} GROUP BY 1, 2) GROUP BY 1")
    L_, S_, T_, F_ = (f"{prefix}w{lab}" for lab in QUARTER_LABELS)
    out[f"{prefix}vol"] = (f"SELECT {L_}.InnerCode, LastQrtSD, SecondQrtSD, ThirdQrtSD, ForthQrtSD FROM {L_} "
                           f"JOIN {S_} ON {S_}.InnerCode = {L_}.InnerCode JOIN {T_} ON {T_}.InnerCode = {L_}.InnerCode "
                           f"JOIN {F_} ON {F_}.InnerCode = {L_}.InnerCode")
    return out


def bench_cte(vol: str) -> str:
    cols = [f"max(CASE WHEN InnerCode = {idx} THEN {lab}QrtSD END) AS {lab}QrtSD_{idx}"
            for idx in (INDEX_2968, INDEX_14110) for lab in QUARTER_LABELS]
    return f"SELECT {', '.join(cols)} FROM {vol}"


def factor_cols(level: str) -> dict[str, str]:
    out = {}
    for lab in QUARTER_LABELS:
        sd, broad, bond = f"{lab}QrtSD", f"{lab}QrtSD_{INDEX_2968}", f"{lab}QrtSD_{INDEX_14110}"
        blend = f"(CAST(0.8 AS DOUBLE) * {broad} + CAST(0.2 AS DOUBLE) * {bond})"
        out[f"{lab}QrtSDFactor"] = (f"CASE WHEN {level} = 'R2' THEN {sd} / {blend} WHEN {level} = 'R3' THEN {sd} / {bond} "
                                    f"WHEN {level} = 'R4' THEN {sd} / {bond} ELSE CAST(0 AS DOUBLE) END")
        out[f"{lab}QrtStandard"] = (f"CASE WHEN {level} = 'R2' THEN CAST(1.4 AS DOUBLE) * {blend} "
                                    f"WHEN {level} = 'R3' THEN CAST(1.4 AS DOUBLE) * {bond} "
                                    f"WHEN {level} = 'R4' THEN CAST(3 AS DOUBLE) * {bond} ELSE CAST(0 AS DOUBLE) END")
    return out


def sd_flag(level_free: bool = True) -> str:
    above = " AND ".join(f"{lab}QrtSD > {lab}QrtStandard" for lab in QUARTER_LABELS)
    below = " AND ".join(f"{lab}QrtSD <= {lab}QrtStandard" for lab in QUARTER_LABELS)
    return f"CASE WHEN {above} THEN 1 WHEN {below} THEN 2 ELSE 0 END"


SDS = [f"{lab}QrtSD" for lab in QUARTER_LABELS]
FACTORS = [f"{lab}QrtSDFactor" for lab in QUARTER_LABELS]
STANDARDS = [f"{lab}QrtStandard" for lab in QUARTER_LABELS]


def fund_name(col: str) -> str:
    whens = " ".join(f"WHEN {s(en)} THEN {s(zh)}" for en, zh in Q.WORD_KEYWORDS.items())
    return f"array_to_string(list_transform(string_split({col}, ' '), lambda w: CASE w {whens} ELSE w END), '')"


PART_FUNDS = f"""SELECT p_partkey, p_name, p_type, p_brand, p_size,
    {fund_name('p_name')} AS ChiName,
    {code6('(p_partkey * 37) % 15000')} AS SecurityCode,
    'R' || CAST(p_size % 5 + 1 AS VARCHAR) AS BaseLevel,
    [12, 14, 15, 17, 11][p_size % 5 + 1] AS FundTypeCode1,
    CASE WHEN [12, 14, 15, 17, 11][p_size % 5 + 1] = 14 AND p_partkey % 2 = 0 THEN 1450
         WHEN [12, 14, 15, 17, 11][p_size % 5 + 1] = 14 THEN 1410
         WHEN [12, 14, 15, 17, 11][p_size % 5 + 1] = 12 AND p_partkey % 2 = 0 THEN 1220
         WHEN [12, 14, 15, 17, 11][p_size % 5 + 1] = 12 THEN 1230
         ELSE [12, 14, 15, 17, 11][p_size % 5 + 1] * 100 + 10 END AS FundTypeCode2,
    CASE WHEN p_partkey % 3 = 0 THEN 1 WHEN p_partkey % 3 = 1 THEN 2 END AS ShareProperties
  FROM part"""


# ---------------------------------------------------------------------------
# master / base / daily / quarterly chains
# ---------------------------------------------------------------------------
def master_ctes(type_cut: dt.date | None, D=D) -> dict[str, str]:
    c = dict(ADAPTER)
    c["sm"] = "SELECT * FROM secumain WHERE SecuCategory IN (8, 13) AND ListedState IN (1, 3, 9)"
    c["ftc"] = f"""SELECT InnerCode, FundType AS FundTypeCode3 FROM (
        SELECT *, row_number() OVER (PARTITION BY InnerCode ORDER BY StartDate DESC NULLS LAST, FundType DESC NULLS LAST) AS rn
        FROM fundtypechangenew {f"WHERE StartDate <= {d(type_cut)}" if type_cut else ""}) WHERE rn = 1
        AND NOT starts_with(CAST(FundType AS VARCHAR), '18')"""
    c["tree"] = """SELECT l1.FundTypeCode AS FundTypeCode1, l1.FundTypeName AS FundTypeName1,
          l2.FundTypeCode AS FundTypeCode2, l2.FundTypeName AS FundTypeName2,
          l3.FundTypeCode AS FundTypeCode3, l3.FundTypeName AS FundTypeName3
        FROM (SELECT * FROM fundtype WHERE Level = 3 AND IfExecuted = 1) l3
        LEFT JOIN (SELECT * FROM fundtype WHERE Level = 2 AND IfExecuted = 1) l2 ON l2.FundTypeCode = l3.FNodeCode
        LEFT JOIN (SELECT * FROM fundtype WHERE Level = 1 AND IfExecuted = 1) l1 ON l1.FundTypeCode = l2.FNodeCode"""
    c["official"] = f"""SELECT InnerCode, {level_code('RiskLevel')} AS OfficialRiskLevel FROM (
        SELECT *, row_number() OVER (PARTITION BY InnerCode ORDER BY BeginDate DESC NULLS LAST, RiskLevel DESC NULLS LAST) AS rn
        FROM fundrisklevel WHERE BeginDate <= {d(D.d1)} AND IfEffected = 1 AND InfoSource <> {s(L.EXCLUDED_INFO_SOURCE)}) WHERE rn = 1"""
    c["master"] = """SELECT sm.InnerCode, sm.ChiName, sm.SecuAbbr, sm.SecuCategory, sm.ListedState,
          fa.MainCode, fa.SecurityCode, fa.ApplyingCodeFront, fa.ApplyingCodeBack, fa.EstablishmentDate,
          fa.EstablishmentDateII, fa.ShareProperties, fa.ExpireDate, ftc.FundTypeCode3,
          tree.FundTypeCode1, tree.FundTypeName1, tree.FundTypeCode2, tree.FundTypeName2, tree.FundTypeName3,
          official.OfficialRiskLevel
        FROM sm LEFT JOIN fundarchives fa ON fa.InnerCode = sm.InnerCode
        JOIN ftc ON ftc.InnerCode = sm.InnerCode
        LEFT JOIN tree ON tree.FundTypeCode3 = ftc.FundTypeCode3
        LEFT JOIN official ON official.InnerCode = sm.InnerCode"""
    return c


def _lookup(src: str, level_name: str) -> str:
    return (f"SELECT {src}.*, rm.RiskLevel AS {level_name} FROM {src} LEFT JOIN risk_mapping rm "
            f"ON rm.FundTypeName1 = {src}.FundTypeName1 AND rm.FundTypeName2 = {src}.FundTypeName2 "
            f"AND rm.FundTypeName3 = {src}.FundTypeName3")


def _apply_x1(src: str, level_in: str, level_out: str) -> str:
    r = x1("ChiName", "FundTypeCode1", "FundTypeCode2", level_in, "ShareProperties")
    return (f"SELECT * REPLACE (coalesce({r['n1']}, FundTypeName1) AS FundTypeName1, "
            f"coalesce({r['n2']}, FundTypeName2) AS FundTypeName2, coalesce({r['n3']}, FundTypeName3) AS FundTypeName3), "
            f"{r['level']} AS {level_out} FROM {src}")


FOF = ("CASE WHEN contains(FundTypeName2, 'FOF') THEN replace(FundTypeName2, 'FOF', '股票FOF') ELSE FundTypeName2 END AS FundTypeName2, "
       "CASE WHEN contains(FundTypeName3, 'FOF') THEN replace(FundTypeName1, 'FOF', '股票FOF') ELSE FundTypeName3 END AS FundTypeName3")


def base_ctes(D=D) -> dict[str, str]:
    c = master_ctes(D.d1, D)
    c["b1"] = _lookup("master", "RiskLevel")
    c["b2"] = _apply_x1("b1", "RiskLevel", "InitRiskLevel")
    c["b3"] = ("SELECT * REPLACE (CASE WHEN contains(FundTypeName2, '指数型') THEN replace(FundTypeName2, '指数型', '指数') "
               "ELSE FundTypeName2 END AS FundTypeName2, CASE WHEN contains(FundTypeName1, '债券基金') "
               "THEN replace(FundTypeName1, '债券基金', '债券基金（不含封闭式）') ELSE FundTypeName1 END AS FundTypeName1) FROM b2")
    c["pred"] = (f"SELECT FundTypeName3 AS PreviousFundTypeName3, MainCode AS MainCodeJ, ExpireDate AS ExpireDateJ, "
                 f"substr(MainCode, 1, 6) AS MainCodeJoin FROM b3 "
                 f"WHERE MainCode LIKE '%J' AND ExpireDate > {d(D.d2)} AND MainCode = SecurityCode")
    c["b4"] = (f"SELECT * REPLACE ({x2('ChiName', 'SecurityCode', 'InitRiskLevel')} AS InitRiskLevel) FROM b3 "
               f"WHERE EstablishmentDate <= {d(D.d1)} AND (ExpireDate > {d(D.d1)} OR ExpireDate IS NULL)")
    c["b5"] = ("SELECT b4.*, pred.* FROM b4 LEFT JOIN pred ON b4.MainCode = pred.MainCodeJoin "
               "AND b4.EstablishmentDate = pred.ExpireDateJ AND b4.EstablishmentDateII IS NOT NULL")
    c["base"] = (f"SELECT * REPLACE ({FOF}, replace(SecurityCode, 'J', '') AS SecurityCode), "
                 f"CASE WHEN length(PreviousFundTypeName3) > 0 THEN '由' || PreviousFundTypeName3 || '转型而来' END AS ChangeReason "
                 f"FROM b5")
    return c


def daily_sql(cut: bool = True) -> str:
    c = master_ctes(Q.AS_OF if cut else None)
    c["ftl"] = (f"SELECT min(CAST(FundTypeCode AS BIGINT)) AS FundTypeCode, FundTypeName "
                f"FROM {values(S.type_code_rows(), ['FundTypeCode', 'FundTypeName'])} GROUP BY FundTypeName")
    c["newest"] = ("SELECT SecurityCode FROM last_batch WHERE EndDate = (SELECT max(EndDate) FROM last_batch) "
                   "AND Number = (SELECT max(Number) FROM last_batch WHERE EndDate = (SELECT max(EndDate) FROM last_batch))")
    c["d1"] = ("SELECT * FROM master m WHERE NOT EXISTS (SELECT 1 FROM newest n WHERE n.SecurityCode = m.SecurityCode)")
    c["d2"] = f"SELECT * REPLACE ({FOF}) FROM d1"
    c["d3"] = _lookup("d2", "InitialRiskLevel")
    c["d4"] = _apply_x1("d3", "InitialRiskLevel", "BasicRiskLevel")
    r = x3("ChiName", "SecurityCode", "BasicRiskLevel")
    c["d5"] = f"SELECT * REPLACE ({r['level']} AS BasicRiskLevel), {r['special']} AS SpecialType FROM d4"
    c["d6"] = "SELECT d5.*, ftl.FundTypeCode AS TypeCode FROM d5 LEFT JOIN ftl ON d5.FundTypeName3 = ftl.FundTypeName"
    final = (f"SELECT InnerCode, {d(Q.AS_OF - dt.timedelta(days=1))} AS EndDate, CAST(TypeCode AS BIGINT) AS FundTypeCode, "
             f"2 AS RLDivisionMode, InitialRiskLevel, {label('InitialRiskLevel')} AS InitialRiskLevelDesc, "
             f"BasicRiskLevel, {label('BasicRiskLevel')} AS BasicRiskLevelDesc, SpecialType, "
             f"CAST(NULL AS VARCHAR) AS Remark, {d(Q.AS_OF)} AS UpdateTime, CAST(NULL AS BIGINT) AS JSID FROM d6")
    return with_ctes(c, final)


def quarterly_sql(D=D, last_qrt: str | None = None) -> str:
    c = base_ctes(D)
    if last_qrt:
        c["last_qrt"] = f"SELECT InnerCode, FundSizeStatus, SDStatus FROM {last_qrt}"
    c.update(vol_ctes("unitnvrestored", "NVRDailyGrowthRate", "f", D))
    c["zz"] = "SELECT * FROM zzqz UNION ALL SELECT * FROM zzzcf"
    c.update(vol_ctes("zz", "ChangePCT", "i", D))
    c["bench"] = bench_cte("ivol")
    c["nav"] = ("SELECT n.*, fa.MainCode FROM mainfinancialindex n LEFT JOIN fundarchives fa ON fa.InnerCode = n.InnerCode")
    label_case = (f"CASE WHEN EndDate > {d(D.d2)} THEN 'Last' WHEN EndDate > {d(D.d3)} THEN 'Second' "
                  f"WHEN EndDate > {d(D.d4)} THEN 'Third' ELSE 'Forth' END")
    sums = ", ".join(f"CAST(sum(CASE WHEN q = '{lab}' THEN v END) AS DECIMAL(38,9)) AS {lab}QrtNV" for lab in QUARTER_LABELS)
    c["navq"] = (f"SELECT MainCode, {sums} FROM (SELECT MainCode, {label_case} AS q, NetAssetsValue * 0.0001 AS v "
                 f"FROM nav WHERE {in_win('EndDate', D.d5, D.d1)}) GROUP BY MainCode")
    c["q1"] = (f"SELECT base.*, navq.LastQrtNV, navq.SecondQrtNV, navq.ThirdQrtNV, navq.ForthQrtNV, "
               f"{months_between(D.d1, 'base.EstablishmentDate')} AS EstablishmentLength "
               f"FROM base LEFT JOIN navq ON navq.MainCode = base.MainCode")
    c["q2"] = (f"SELECT q1.*, {size_flag('ForthQrtNV', 'ThirdQrtNV', 'SecondQrtNV', 'LastQrtNV')} AS NetAssetFlag, "
               f"lq.FundSizeStatus, lq.SDStatus, fvol.LastQrtSD, fvol.SecondQrtSD, fvol.ThirdQrtSD, fvol.ForthQrtSD "
               f"FROM q1 LEFT JOIN last_qrt lq ON lq.InnerCode = q1.InnerCode LEFT JOIN fvol ON fvol.InnerCode = q1.InnerCode")
    fc = factor_cols("InitRiskLevel")
    c["q3"] = "SELECT q2.*, " + ", ".join(f"{v} AS {k}" for k, v in fc.items()) + " FROM q2, bench"
    c["q4"] = f"SELECT *, {sd_flag()} AS SDFlag FROM q3"
    r = x6("InitRiskLevel", "EstablishmentLength", "NetAssetFlag", "FundSizeStatus", "SDStatus", "SDFlag")
    c["q5"] = (f"SELECT * REPLACE (coalesce({r['sd']}, SDStatus) AS SDStatus, coalesce({r['size']}, FundSizeStatus) AS FundSizeStatus, "
               f"coalesce({r['reason']}, ChangeReason) AS ChangeReason), {r['level']} AS FinalRiskLevel FROM q4")
    c["q6"] = f"SELECT *, {direction('ChangeReason')} AS ChangeDirection FROM q5"
    w = "OVER (PARTITION BY MainCode ORDER BY IsMain, InnerCode)"
    c["q7"] = (f"SELECT InnerCode, MainCode, SecurityCode AS SecuCode, ApplyingCodeFront, ApplyingCodeBack, SecuAbbr, "
               f"EstablishmentDate AS EstablishDate, FundTypeCode1 AS FirstCategory, FundTypeName1 AS FirstCategoryName, "
               f"FundTypeCode2 AS SecondCategory, FundTypeName2 AS SecondCategoryName, FundTypeCode3 AS ThirdCategory, "
               f"FundTypeName3 AS ThirdCategoryName, InitRiskLevel AS BasicRiskLevel, "
               f"first_value(FundSizeStatus) {w} AS FundSizeStatus, first_value(SDStatus) {w} AS SDStatus, "
               f"LastQrtNV, SecondQrtNV, ThirdQrtNV, ForthQrtNV, LastQrtSD, SecondQrtSD, ThirdQrtSD, ForthQrtSD, "
               f"LastQrtSDFactor, SecondQrtSDFactor, ThirdQrtSDFactor, ForthQrtSDFactor, "
               f"first_value(FinalRiskLevel) {w} AS RiskLevel, first_value(ChangeDirection) {w} AS ChangeDirection, "
               f"first_value(ChangeReason) {w} AS ChangeReason, first_value(OfficialRiskLevel) {w} AS OfficialRiskLevel "
               f"FROM (SELECT *, CASE WHEN MainCode = SecurityCode THEN 1 ELSE 2 END AS IsMain FROM q6)")
    zero_d = "CAST(0 AS DECIMAL(38,9))"
    nv = ", ".join(f"coalesce({lab}QrtNV, {zero_d}) AS {lab}QrtNV" for lab in QUARTER_LABELS)
    dbl = ", ".join(f"coalesce({col}, CAST(0 AS DOUBLE)) AS {col}" for col in SDS + FACTORS)
    final = (f"SELECT * REPLACE ({nv}, {dbl}, coalesce(FundSizeStatus, 0) AS FundSizeStatus, coalesce(SDStatus, 0) AS SDStatus), "
             f"{d(D.d1)} AS EndDate, 2 AS RLDivisionMode, greatest(RiskLevel, OfficialRiskLevel) AS HigherRiskLevel, "
             f"{d(D.as_of)} AS UpdateTime, {label('RiskLevel')} AS RiskLevelName, "
             f"{label('OfficialRiskLevel')} AS OfficialRiskLevelName, "
             f"{label('greatest(RiskLevel, OfficialRiskLevel)')} AS HigherRiskLevelName, "
             f"CAST(NULL AS VARCHAR) AS Remark, CAST(NULL AS BIGINT) AS JSID FROM q7")
    return with_ctes(c, final)


def history_sql() -> str:
    """One quarterly rating after the other, each taking its statuses from the one before."""
    runs = [rating_dates(x) for x in Q.HISTORY]
    parts = [f"r{i} AS ({quarterly_sql(r, f'r{i - 1}' if i else None)})" for i, r in enumerate(runs)]
    return "WITH " + ",\n".join(parts) + "\n" + " UNION ALL BY NAME ".join(f"SELECT * FROM r{i}" for i in range(len(runs)))


def fold_sql() -> str:
    """The state machine as a recursive query over each customer's quarters."""
    r = x6("level", "months", "size_flag", "s", "v", "sd_flag")
    return f"""WITH RECURSIVE o AS (
          SELECT o_custkey, o_orderkey AS k, CAST(o_orderdate AS DATE) AS day,
            row_number() OVER (PARTITION BY o_custkey, date_trunc('quarter', CAST(o_orderdate AS DATE)) ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS newest
          FROM orders),
        n AS (
          SELECT o_custkey, k, row_number() OVER (PARTITION BY o_custkey ORDER BY day) AS i,
            CASE WHEN k % 6 <> 5 THEN 'R' || CAST(k % 6 + 1 AS VARCHAR) END AS level, {months_between(Q.AS_OF, 'day')} AS months,
            CAST(k % 3 AS INTEGER) AS size_flag, CAST(k % 13 % 3 AS INTEGER) AS sd_flag FROM o WHERE newest = 1),
        f(o_custkey, i, k, RiskLevel, ChangeReason, s, v) AS (
          SELECT DISTINCT o_custkey, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 0, 0 FROM n
          UNION ALL
          SELECT o_custkey, i, k, {r['level']}, {r['reason']}, coalesce({r['size']}, s), coalesce({r['sd']}, v)
          FROM (SELECT n.*, CASE WHEN n.k % 10 <> 0 THEN f.s ELSE 0 END AS s, CASE WHEN n.k % 10 <> 0 THEN f.v ELSE CAST(n.k % 20 // 10 AS INTEGER) END AS v
                FROM f JOIN n ON n.o_custkey = f.o_custkey AND n.i = f.i + 1))
        SELECT o_custkey, k AS o_orderkey, RiskLevel, ChangeReason, s AS FundSizeStatus, v AS SDStatus FROM f WHERE i > 0"""


# ---------------------------------------------------------------------------
# the per-key SQL
# ---------------------------------------------------------------------------
def _sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o["scan_schema"] = "SELECT c_custkey, c_name, c_mktsegment FROM customer"
    o["project_alias"] = ("SELECT o_orderkey AS order_id, o_custkey AS cust_id, CAST(o_orderdate AS DATE) AS order_day, "
                          "o_totalprice / 10000 AS price_10k FROM orders")
    o["rename_drop"] = "SELECT p_partkey AS PartCode, p_name AS PartName, p_brand, p_type AS PartType, p_size FROM part"
    o["const_null_cols"] = (f"SELECT s_suppkey, s_name, 2 AS RLDivisionMode, CAST(NULL AS VARCHAR) AS Remark, "
                            f"CAST(NULL AS BIGINT) AS JSID, {d(D.d1)} AS EndDate, {d(Q.AS_OF)} AS UpdateTime FROM supplier")
    o["fill_zero"] = ("SELECT c_custkey, coalesce(total_price, CAST(0 AS DECIMAL(38,2))) AS total_price, "
                      "coalesce(n_orders, 0) AS n_orders FROM customer LEFT JOIN ("
                      "SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_price, "
                      "count(*) AS n_orders FROM orders GROUP BY o_custkey) s ON s.o_custkey = c_custkey")
    o["filter_in"] = ("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer "
                      "WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey IN (1, 3, 9)")
    o["filter_neq_null"] = ("SELECT c_custkey, o_orderkey, o_orderpriority FROM customer LEFT JOIN orders "
                            "ON c_custkey = o_custkey WHERE o_orderpriority <> '5-LOW'")
    o["alive_at"] = (f"SELECT * FROM (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS start_day, "
                     f"CASE WHEN o_custkey % 3 <> 0 THEN max(CAST(o_orderdate AS DATE)) END AS end_day "
                     f"FROM orders GROUP BY o_custkey) WHERE start_day <= {d(D.d1)} AND (end_day > {d(D.d1)} OR end_day IS NULL)")
    wins = values([(lab, lo.isoformat(), hi.isoformat()) for lab, lo, hi in D.vol_windows], ["qrt_window", "lo_s", "hi_s"])
    o["range_windows"] = (f"SELECT w.qrt_window, CAST(w.lo_s AS DATE) AS lo, CAST(w.hi_s AS DATE) AS hi, count(l.d) AS n_rows "
                          f"FROM {wins.replace(' AS t(', ' AS w(')} LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem) l "
                          f"ON l.d > CAST(w.lo_s AS DATE) AND l.d <= CAST(w.hi_s AS DATE) GROUP BY ALL")
    ev = (f"SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn "
          f"FROM events WHERE CAST(ts AS DATE) <= {d(Q.EVENT_CUT)}")
    o["asof_latest"] = f"SELECT user_id, ts, event_id, event_type FROM ({ev}) WHERE rn = 1 AND NOT starts_with(event_type, 'err')"
    o["asof_latest_rating"] = f"SELECT user_id, {level_code('floor(value / 80) + 1')} AS OfficialRiskLevel FROM ({ev}) WHERE rn = 1"
    dates = values([(x.isoformat(),) for x in Q.ASOF_DATES], ["x"])
    o["asof_dates"] = (f"SELECT user_id, as_of, ts, event_id, event_type FROM (SELECT e.*, a.as_of, row_number() OVER ("
                       f"PARTITION BY user_id, a.as_of ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn "
                       f"FROM events e JOIN (SELECT CAST(x AS DATE) AS as_of FROM {dates}) a ON CAST(e.ts AS DATE) <= a.as_of) WHERE rn = 1")
    o["latest_batch"] = ("WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, o_orderpriority FROM orders), "
                         "y AS (SELECT * FROM x WHERE order_day = (SELECT max(order_day) FROM x)) "
                         "SELECT * FROM y WHERE o_orderpriority = (SELECT max(o_orderpriority) FROM y)")
    o["join_left"] = ("SELECT c_custkey AS custkey, c_name, o_orderkey, o_totalprice FROM customer "
                      "LEFT JOIN orders ON c_custkey = o_custkey")
    o["join_inner"] = ("SELECT c_custkey AS custkey, c_name, o_orderkey, o_totalprice FROM customer "
                       "JOIN orders ON c_custkey = o_custkey")
    o["join_left_renamed"] = "SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"
    o["join_anti"] = ("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey "
                      "AND CAST(o_orderdate AS DATE) > CAST((SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - INTERVAL 12 MONTH AS DATE))")
    o["hierarchy_join"] = """WITH nodes AS (
          SELECT CAST(r_regionkey AS BIGINT) AS code, r_name AS name, CAST(0 AS BIGINT) AS parent, 1 AS lvl, 1 AS ex FROM region
          UNION ALL SELECT CAST(n_nationkey + 1000 AS BIGINT), n_name, CAST(n_regionkey AS BIGINT), 2,
                 CASE WHEN n_nationkey % 7 = 3 THEN 0 ELSE 1 END FROM nation
          UNION ALL SELECT s_suppkey + 100000, s_name, CAST(s_nationkey + 1000 AS BIGINT), 3, 1 FROM supplier)
        SELECT l1.code AS FundTypeCode1, l1.name AS FundTypeName1, l2.code AS FundTypeCode2, l2.name AS FundTypeName2,
               l3.code AS FundTypeCode3, l3.name AS FundTypeName3
        FROM (SELECT * FROM nodes WHERE lvl = 3 AND ex = 1) l3
        LEFT JOIN (SELECT * FROM nodes WHERE lvl = 2 AND ex = 1) l2 ON l2.code = l3.parent
        LEFT JOIN (SELECT * FROM nodes WHERE lvl = 1 AND ex = 1) l1 ON l1.code = l2.parent"""
    o["hierarchy_paths"] = o["hierarchy_join"]
    conf = values(Q.lookup_rows(), ["r_name", "n_name", "c_mktsegment", "RiskLevel"])
    o["lookup_three_key"] = (f"SELECT b.c_custkey, b.r_name, b.n_name, b.c_mktsegment, t.RiskLevel FROM ("
                             f"SELECT c_custkey, r_name, n_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey "
                             f"JOIN region ON n_regionkey = r_regionkey) b LEFT JOIN {conf} ON t.r_name = b.r_name "
                             f"AND t.n_name = b.n_name AND t.c_mktsegment = b.c_mktsegment")
    cj = dict(ADAPTER)
    cj["arch"] = ("SELECT fa.*, sm.SecuAbbr AS FundTypeName3 FROM fundarchives fa JOIN secumain sm ON sm.InnerCode = fa.InnerCode")
    cj["pred"] = (f"SELECT FundTypeName3 AS PreviousFundTypeName3, MainCode AS MainCodeJ, ExpireDate AS ExpireDateJ, "
                  f"substr(MainCode, 1, 6) AS MainCodeJoin FROM arch WHERE MainCode LIKE '%J' AND ExpireDate > {d(D.d2)} "
                  f"AND MainCode = SecurityCode")
    o["conversion_join"] = with_ctes(cj, (
        "SELECT a.InnerCode, a.MainCode, a.SecurityCode, p.PreviousFundTypeName3, "
        "CASE WHEN length(p.PreviousFundTypeName3) > 0 THEN '由' || p.PreviousFundTypeName3 || '转型而来' END AS ChangeReason "
        "FROM arch a LEFT JOIN pred p ON a.MainCode = p.MainCodeJoin AND a.EstablishmentDate = p.ExpireDateJ "
        "AND a.EstablishmentDateII IS NOT NULL"))
    qlab = (f"CASE WHEN EndDate > {d(D.d2)} THEN 'Last' WHEN EndDate > {d(D.d3)} THEN 'Second' "
            f"WHEN EndDate > {d(D.d4)} THEN 'Third' ELSE 'Forth' END")
    onav = (f"SELECT o_custkey, CAST(o_orderdate AS DATE) AS EndDate, CAST(o_totalprice AS DECIMAL(18,3)) AS NetAssetsValue "
            f"FROM orders")
    o["nav_sum"] = (f"SELECT o_custkey, {qlab} || 'QrtNV' AS Qrt, CAST(sum(NetAssetsValue * 0.0001) AS DECIMAL(38,9)) AS NetAssetsValueSum "
                    f"FROM ({onav}) WHERE {in_win('EndDate', D.d5, D.d1)} GROUP BY ALL")
    piv = ", ".join(f"CAST(sum(CASE WHEN q = '{lab}' THEN v END) AS DECIMAL(38,9)) AS {lab}QrtNV" for lab in QUARTER_LABELS)
    o["nav_pivot"] = (f"SELECT o_custkey, {piv} FROM (SELECT o_custkey, {qlab} AS q, NetAssetsValue * 0.0001 AS v FROM ({onav}) "
                      f"WHERE {in_win('EndDate', D.d5, D.d1)}) GROUP BY o_custkey")
    o["size_flag"] = with_ctes(ADAPTER, (
        f"SELECT *, {size_flag('ForthQrtNV', 'ThirdQrtNV', 'SecondQrtNV', 'LastQrtNV')} AS NetAssetFlag FROM ("
        f"SELECT InnerCode, {piv} FROM (SELECT InnerCode, {qlab} AS q, NetAssetsValue * 0.0001 AS v FROM mainfinancialindex "
        f"WHERE {in_win('EndDate', D.d5, D.d1)}) GROUP BY InnerCode)"))
    o["week_bucket"] = (f"SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS TradingDay, "
                        f"{week('CAST(l_shipdate AS DATE)')} AS weekNum FROM lineitem")
    o["date_parts"] = (f"SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, CAST(o_orderdate AS DATE) - 1 AS day_before, "
                       f"CAST(CAST(o_orderdate AS DATE) - INTERVAL 12 MONTH AS DATE) AS year_before, {d(D.d1)} AS EndDate, "
                       f"{d(Q.AS_OF)} AS UpdateTime FROM orders")
    o["tenure_months"] = (f"SELECT o_orderkey, {months_between(D.d1, 'CAST(o_orderdate AS DATE)')} AS EstablishmentLength FROM orders")
    qe = ", ".join(f"last_day(CAST(date_trunc('quarter', CAST(o_orderdate AS DATE)) - INTERVAL {1 + 3 * k} MONTH AS DATE)) AS d{k + 1}"
                   for k in range(4))
    o["quarter_ends"] = (f"SELECT *, CAST(d1 - INTERVAL 12 MONTH AS DATE) AS d5, CAST(d1 - INTERVAL 36 MONTH AS DATE) AS d6, "
                         f"CAST(d2 - INTERVAL 36 MONTH AS DATE) AS d7, CAST(d3 - INTERVAL 36 MONTH AS DATE) AS d8, "
                         f"CAST(d4 - INTERVAL 36 MONTH AS DATE) AS d9 FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, {qe} FROM orders)")
    o["weekly_return"] = with_ctes(ADAPTER, (
        f"SELECT InnerCode, {week('TradingDay')} AS weekNum, {compound(factor('NVRDailyGrowthRate'))} AS weekly_return "
        f"FROM unitnvrestored GROUP BY ALL"))
    c1 = dict(ADAPTER)
    c1.update({k: v for k, v in vol_ctes("unitnvrestored", "NVRDailyGrowthRate", "f").items() if k == "fwLast"})
    o["volatility_1q"] = with_ctes(c1, f"SELECT InnerCode, LastQrtSD FROM fwLast")
    c4 = dict(ADAPTER)
    c4.update(vol_ctes("unitnvrestored", "NVRDailyGrowthRate", "f"))
    o["volatility_4q"] = with_ctes(c4, f"SELECT InnerCode, {', '.join(SDS)} FROM fvol")
    o["volatility_incremental"] = o["volatility_4q"]
    runs = [rating_dates(x) for x in Q.HISTORY]
    ch = dict(ADAPTER)
    for i, r in enumerate(runs):
        ch.update(vol_ctes("unitnvrestored", "NVRDailyGrowthRate", f"h{i}", r))
    o["volatility_history"] = with_ctes(ch, " UNION ALL ".join(f"SELECT InnerCode, {d(r.d1)} AS D1, {', '.join(SDS)} FROM h{i}vol" for i, r in enumerate(runs)))
    o["union_series"] = with_ctes(ADAPTER, "SELECT * FROM zzqz UNION ALL SELECT * FROM zzzcf")
    ci = dict(ADAPTER)
    ci["zz"] = "SELECT * FROM zzqz UNION ALL SELECT * FROM zzzcf"
    ci.update(vol_ctes("zz", "ChangePCT", "i"))
    ci["bench"] = bench_cte("ivol")
    bcols = [f"{lab}QrtSD_{idx}" for idx in (INDEX_2968, INDEX_14110) for lab in QUARTER_LABELS]
    o["benchmark_row"] = with_ctes(ci, f"SELECT {', '.join(bcols)} FROM bench")
    cf = dict(ci)
    cf.update(vol_ctes("unitnvrestored", "NVRDailyGrowthRate", "f"))
    fc = factor_cols("level")
    cf["ff"] = ("SELECT fvol.*, 'R' || CAST(InnerCode % 5 + 1 AS VARCHAR) AS level FROM fvol")
    cf["fx"] = "SELECT ff.*, " + ", ".join(f"{v} AS {k}" for k, v in fc.items()) + " FROM ff, bench"
    o["sd_factor"] = with_ctes(cf, f"SELECT InnerCode, level, {', '.join(FACTORS + STANDARDS)} FROM fx")
    o["sd_flag"] = with_ctes(cf, f"SELECT InnerCode, level, {sd_flag()} AS SDFlag FROM fx")
    o["keyword_cascade"] = (f"SELECT p_partkey, ChiName, CASE WHEN {has('ChiName', '原油', '商品', '通胀')} THEN 'commodity' "
                            f"WHEN {has('ChiName', '黄金', '上海金')} THEN 'gold' WHEN contains(ChiName, '期货') THEN 'futures' "
                            f"WHEN {has('ChiName', '科创', '科技创新')} THEN 'sci-tech' WHEN contains(upper(ChiName), 'REIT') THEN 'reit' "
                            f"WHEN contains(ChiName, '同业存单') THEN 'cd' ELSE 'other' END AS keyword_class FROM ({PART_FUNDS})")
    n1 = lst(["债券基金", "股票基金", "FOF", "混合基金"])
    n2 = lst(["指数型债券基金", "股票FOF", "主动投资混合基金", "指数型股票基金", "FOF"])
    n3 = lst(["股票FOF", "普通股票基金", "其他FOF", "纯债基金"])
    o["normalise_names"] = (
        f"SELECT p_partkey, FundTypeName1, FundTypeName2, "
        f"CASE WHEN contains(FundTypeName3, 'FOF') THEN replace(FundTypeName1, 'FOF', '股票FOF') ELSE FundTypeName3 END AS FundTypeName3 "
        f"FROM (SELECT p_partkey, "
        f"CASE WHEN contains(FundTypeName1, '债券基金') THEN replace(FundTypeName1, '债券基金', '债券基金（不含封闭式）') ELSE FundTypeName1 END AS FundTypeName1, "
        f"CASE WHEN contains(n2x, 'FOF') THEN replace(n2x, 'FOF', '股票FOF') ELSE n2x END AS FundTypeName2, FundTypeName3 "
        f"FROM (SELECT *, CASE WHEN contains(FundTypeName2, '指数型') THEN replace(FundTypeName2, '指数型', '指数') ELSE FundTypeName2 END AS n2x "
        f"FROM (SELECT p_partkey, {n1}[p_partkey % 4 + 1] AS FundTypeName1, {n2}[p_partkey % 5 + 1] AS FundTypeName2, "
        f"{n3}[p_size % 4 + 1] AS FundTypeName3 FROM part)))")
    r3 = x3("ChiName", "SecurityCode", "BaseLevel")
    o["unpack_rule_struct"] = f"SELECT p_partkey, {r3['level']} AS BasicRiskLevel, {r3['special']} AS SpecialType FROM ({PART_FUNDS})"
    o["bucket_case"] = (f"SELECT o_orderkey, {qlab.replace('EndDate', 'CAST(o_orderdate AS DATE)')} AS Qrt FROM orders "
                        f"WHERE {in_win('CAST(o_orderdate AS DATE)', D.d5, D.d1)}")
    o["code_list_override"] = (f"SELECT p_partkey, SecurityCode, ChiName, BaseLevel, "
                               f"{x2('ChiName', 'SecurityCode', 'BaseLevel')} AS InitRiskLevel FROM ({PART_FUNDS})")
    o["special_rule_daily"] = (f"SELECT p_partkey, SecurityCode, {r3['level']} AS BasicRiskLevel, {r3['special']} AS SpecialType "
                               f"FROM ({PART_FUNDS})")
    r1 = x1("ChiName", "FundTypeCode1", "FundTypeCode2", "BaseLevel", "ShareProperties")
    o["base_risk_rule"] = (f"SELECT p_partkey, {r1['level']} AS InitRiskLevel, coalesce({r1['n1']}, p_type) AS FundTypeName1, "
                           f"coalesce({r1['n2']}, p_brand) AS FundTypeName2, coalesce({r1['n3']}, p_name) AS FundTypeName3 "
                           f"FROM ({PART_FUNDS})")
    r6 = x6("level", "months", "NetAssetFlag", "FundSizeStatus", "SDStatus", "SDFlag")
    fr_in = (f"SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 5 THEN 'R' || CAST(o_orderkey % 6 + 1 AS VARCHAR) END AS level, "
             f"{months_between(D.d1, 'CAST(o_orderdate AS DATE)')} AS months, CAST(o_orderkey % 3 AS INTEGER) AS NetAssetFlag, "
             f"CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 7 % 2 AS INTEGER) END AS FundSizeStatus, "
             f"CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 11 % 2 AS INTEGER) END AS SDStatus, "
             f"CAST(o_orderkey % 13 % 3 AS INTEGER) AS SDFlag FROM orders")
    o["final_rating"] = (f"SELECT *, {direction('ChangeReason')} AS ChangeDirection FROM ("
                         f"SELECT o_orderkey, {r6['level']} AS RiskLevel, {r6['reason']} AS ChangeReason, "
                         f"coalesce({r6['size']}, FundSizeStatus) AS FundSizeStatus, coalesce({r6['sd']}, SDStatus) AS SDStatus "
                         f"FROM ({fr_in}))")
    pw = "OVER (PARTITION BY MainCode ORDER BY IsMain, p_partkey)"
    o["propagate_main"] = (f"SELECT p_partkey, MainCode, IsMain, first_value(RiskLevel) {pw} AS RiskLevel, "
                           f"first_value(ChangeReason) {pw} AS ChangeReason FROM ("
                           f"SELECT p_partkey, p_brand AS MainCode, CASE WHEN p_type = 'STANDARD' THEN 1 ELSE 2 END AS IsMain, "
                           f"CASE WHEN p_size % 7 <> 0 THEN 'R' || CAST(p_size % 5 + 1 AS VARCHAR) END AS RiskLevel, "
                           f"p_name AS ChangeReason FROM part)")
    two = ("SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 5 THEN 'R' || CAST(o_orderkey % 6 + 1 AS VARCHAR) END AS RiskLevel, "
           "CASE WHEN o_custkey % 6 <> 5 THEN 'R' || CAST(o_custkey % 6 + 1 AS VARCHAR) END AS OfficialRiskLevel FROM orders")
    o["higher_level"] = f"SELECT *, greatest(RiskLevel, OfficialRiskLevel) AS HigherRiskLevel FROM ({two})"
    o["level_label"] = (f"SELECT o_orderkey, {label('RiskLevel')} AS RiskLevelName, {label('OfficialRiskLevel')} AS OfficialRiskLevelName "
                        f"FROM ({two})")
    mcols = ", ".join(Q.MASTER_COLUMNS)
    o["master"] = with_ctes(master_ctes(D.d1), f"SELECT {mcols} FROM master")
    o["rating_base"] = with_ctes(base_ctes(), f"SELECT {', '.join(Q.BASE_COLUMNS)} FROM base")
    o["rating_daily"] = daily_sql()
    o["rating_daily_uncut"] = daily_sql(cut=False)
    o["rating_quarterly"] = quarterly_sql()
    o["rating_history"] = history_sql()
    o["state_fold"] = fold_sql()
    o["csv_headerless"] = with_ctes(ADAPTER, "SELECT * FROM mainfinancialindex")
    o["csv_two_headers"] = with_ctes(ADAPTER, "SELECT * FROM unitnvrestored")
    o["csv_cp936"] = with_ctes(ADAPTER, "SELECT * REPLACE (nullif(ChiName, '') AS ChiName) FROM secumain")
    return o


ORACLE_SQL = _sql()
