"""The rating rules as native Column expressions (no Python worker, codegen kept).

Each rule is a first-match-wins ``when`` chain. SQL three-valued logic gives the
same answer as the original row rules for every null pattern: a comparison with a
null is never taken, so evaluation falls through to the branch default.

Rules that rewrite several fields return a struct with named fields instead of a
``level-a-b-c`` packed string, so no field order or separator can leak into data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskladder.functions import lookups as L


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _has(name: Column, *words: str) -> Column:
    cond = None
    for w in words:
        c = name.contains(w)
        cond = c if cond is None else cond | c
    return cond


# --- X1: basic rule by type tree, keywords and tranche ---------------------
# fixed values: (level, type name 1, 2, 3) produced by the rule
_QDII_COMMODITY = ("R5", "QDII基金", "商品QDII基金", "商品QDII基金（除黄金QDII）")
_QDII_GOLD = ("R3", "QDII基金", "商品QDII基金", "黄金QDII基金")
_COMMODITY = ("R5", "商品基金", "商品基金", "商品基金（除黄金基金）")
_GOLD = ("R3", "商品基金", "商品基金", "黄金基金")
_CB_GRADED_SENIOR = ("R3", "债券基金", "债券分级子基金", "可转债分级子基金（优先份额）")
_CB_GRADED_JUNIOR = ("R5", "债券基金", "债券分级子基金", "可转债分级子基金（进取份额）")
_BOND_GRADED_SENIOR = ("R3", "债券基金", "债券分级子基金", "普通债券分级子基金（优先份额）")
_BOND_GRADED_JUNIOR = ("R4", "债券基金", "债券分级子基金", "普通债券分级子基金（进取份额）")
_CB_INDEX = ("R3", "债券基金", "指数型债券基金", "可转债指数基金")


_KEEP_LEVEL = None
# fixed values: outcome per branch of X1, in first-match order: (level, name1, name2, name3);
# a None level keeps the input level, None names keep the current names.
BASE_OUTCOMES = [
    ("R3", None, None, None),      # 0  FOF
    _QDII_COMMODITY,               # 1  commodity QDII
    _QDII_GOLD,                    # 2  gold QDII
    (_KEEP_LEVEL, None, None, None),   # 3  other commodity QDII
    _COMMODITY,                    # 4  commodity futures fund
    _GOLD,                         # 5  gold fund
    (_KEEP_LEVEL, None, None, None),   # 6  other commodity fund
    _CB_GRADED_SENIOR,             # 7
    _CB_GRADED_JUNIOR,             # 8
    _BOND_GRADED_SENIOR,           # 9
    _BOND_GRADED_JUNIOR,           # 10
    _CB_INDEX,                     # 11
    (_KEEP_LEVEL, None, None, None),   # 12 anything else
]


def base_risk_branch(name, code1, code2, share) -> Column:
    """X1 decision: index into ``BASE_OUTCOMES`` (first matching condition)."""
    name, code1, code2, share = map(_c, (name, code1, code2, share))
    qdii = (code1 == 14) & (code2 == 1450)
    bond = code1 == 12
    cb, graded = name.contains("可转换债券"), name.contains("分级")
    conditions = [
        code1 == 15,
        qdii & _has(name, "原油", "商品", "通胀"),
        qdii & name.contains("黄金"),
        qdii,
        (code1 == 17) & name.contains("期货"),
        (code1 == 17) & _has(name, "黄金", "上海金"),
        code1 == 17,
        bond & cb & graded & (share == 1),
        bond & cb & graded & (share == 2),
        bond & ~cb & graded & (share == 1),
        bond & ~cb & graded & (share == 2),
        bond & (code2 == 1220) & cb,
    ]
    branch = F.when(conditions[0], 0)
    for i, cond in enumerate(conditions[1:], start=1):
        branch = branch.when(cond, i)
    return branch.otherwise(len(conditions))


def _outcome(table: list[tuple], field: int, branch: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o[field]).cast("string") for o in table]), branch + 1)


def base_risk_outcome(branch, level) -> Column:
    """struct(level, name1, name2, name3) of a branch of ``BASE_OUTCOMES`` (fixed
    levels are never null, so a null table level means: keep the input level)."""
    b, lv = _c(branch), _c(level)
    return F.struct(F.coalesce(_outcome(BASE_OUTCOMES, 0, b), lv).alias("level"),
                    _outcome(BASE_OUTCOMES, 1, b).alias("name1"), _outcome(BASE_OUTCOMES, 2, b).alias("name2"),
                    _outcome(BASE_OUTCOMES, 3, b).alias("name3"))


def base_risk_rule(name, code1, code2, level, share) -> Column:
    """X1 -> struct(level, name1, name2, name3) as one expression; names are null when unchanged."""
    return base_risk_outcome(base_risk_branch(name, code1, code2, share), level)


def apply_base_rule(df, level_in: str, level_out: str):
    """Run X1 and replace the three type names where the rule gives them
    (branch number first, so the conditions are evaluated once)."""
    b = base_risk_branch("ChiName", "FundTypeCode1", "FundTypeCode2", "ShareProperties")
    return (df.withColumn("_x1b", b)
              .withColumns({
                  "FundTypeName1": F.coalesce(_outcome(BASE_OUTCOMES, 1, F.col("_x1b")), F.col("FundTypeName1")),
                  "FundTypeName2": F.coalesce(_outcome(BASE_OUTCOMES, 2, F.col("_x1b")), F.col("FundTypeName2")),
                  "FundTypeName3": F.coalesce(_outcome(BASE_OUTCOMES, 3, F.col("_x1b")), F.col("FundTypeName3")),
                  level_out: F.coalesce(_outcome(BASE_OUTCOMES, 0, F.col("_x1b")), F.col(level_in))})
              .drop("_x1b"))


# --- X2 / X3: special funds by keyword and code list -----------------------
def _blank(name: Column) -> Column:
    return name.isNull() | (name == "")


def _sci_tech(name: Column) -> Column:
    return _has(name, "科创", "科技创新")


def _reit(name: Column) -> Column:
    return F.upper(name).contains("REIT")


def special_rule_quarterly(name, code, level) -> Column:
    """X2: keyword / code-list override of the quarterly base level."""
    name, code, level = map(_c, (name, code, level))
    return (F.when(_blank(name), level)
            .when(_sci_tech(name), F.lit("R4"))
            .when(_reit(name), F.lit("R4"))
            .when(code.isin(L.NEEQ_R3), F.lit("R3"))
            .when(code.isin(L.QUARTERLY_R4), F.lit("R4"))
            .otherwise(level))


def special_rule_daily(name, code, level) -> Column:
    """X3 -> struct(level, special); special is null where the rule gives none."""
    name, code, level = map(_c, (name, code, level))

    def s(lv, special=None):
        lv = F.lit(lv) if isinstance(lv, str) else lv
        sp = F.lit(special).cast("long") if special is not None else F.lit(None).cast("long")
        return F.struct(lv.alias("level"), sp.alias("special"))

    return (F.when(_blank(name), s(level))
            .when(_sci_tech(name), s("R4", 1))
            .when(_reit(name), s("R4", 2))
            .when(code.isin(L.NEEQ_R3), s("R3", 3))
            .when(code.isin(L.NEEQ_R4), s("R4", 3))
            .when(code.isin(L.BEIJING_R4), s("R4", 4))
            .when(name.contains("同业存单AAA指数7天"), s("R1"))
            .when(name.contains("同业存单"), s("R2"))
            .otherwise(s(level)))


# --- X4: conversion remark -------------------------------------------------
def conversion_remark(previous_name3) -> Column:
    """X4: remark naming the type a converted fund came from; null or empty in -> null."""
    c = _c(previous_name3)
    return F.when(F.length(c) > 0, F.format_string(L.CONVERSION_REMARK, c))


# --- X5: size flag ---------------------------------------------------------
def size_flag(forth, third, second, last) -> Column:
    """1 = small (last < 1000, or all four < 5000); 2 = all four > 5000; else 0."""
    f, t, s, l = map(_c, (forth, third, second, last))
    return (F.when(l < 1000, 1)
            .when((l < 5000) & (s < 5000) & (t < 5000) & (f < 5000), 1)
            .when((l > 5000) & (s > 5000) & (t > 5000) & (f > 5000), 2)
            .otherwise(0))


# --- X8: volatility flag ---------------------------------------------------
def sd_flag(sds: list, standards: list) -> Column:
    """1 = every SD above its standard; 2 = every SD at or below; else 0."""
    above = below = None
    for sd, std in zip(map(_c, sds), map(_c, standards)):
        a, b = sd > std, sd <= std
        above = a if above is None else above & a
        below = b if below is None else below & b
    return F.when(above, 1).when(below, 2).otherwise(0)


# --- X6: final rating state machine ----------------------------------------
def level_up(level) -> Column:
    """One step riskier, capped at R5; null stays null."""
    digit = F.substring(_c(level), -1, 1).try_cast("int")
    return F.when(digit.isNotNull(), F.concat(F.lit("R"), F.least(digit + 1, F.lit(5)).cast("string")))


# fixed values: one row per branch of the state machine, in first-match order:
# (level: keep or up, reason, new size status, new volatility status); None = unchanged.
_UP, _KEEP = "up", "keep"
FINAL_OUTCOMES = [
    (_KEEP, None, None, None),                                            # 0  younger than 18 months
    (_KEEP, L.REASON_SIZE_UP, 0, 0),                                      # 1  18-42: size back up
    (_UP, None, None, None),                                              # 2  18-42: uplift stays
    (_UP, L.REASON_SIZE_DOWN, 1, 0),                                      # 3  18-42: size down
    (_KEEP, None, None, None),                                            # 4  18-42: otherwise
    (_KEEP, L.REASON_SIZE_UP + "," + L.REASON_SD_DOWN, 0, 0),             # 5  >42: both revert
    (_KEEP, L.REASON_SIZE_UP, 0, 0),                                      # 6  >42: size reverts
    (_KEEP, L.REASON_SD_DOWN, 0, 0),                                      # 7  >42: volatility reverts
    (_UP, None, None, None),                                              # 8  >42: uplift stays
    (_UP, L.REASON_SIZE_DOWN + "," + L.REASON_SD_UP, 1, 1),               # 9  >42: both up
    (_UP, L.REASON_SIZE_DOWN, 1, 0),                                      # 10 >42: size down
    (_UP, L.REASON_SD_UP, 0, 1),                                          # 11 >42: volatility up
    (_KEEP, None, None, None),                                            # 12 otherwise
]


def final_rating_branch(level, months, size_f, size_status, sd_status, sd_f) -> Column:
    """X6 decision: index into ``FINAL_OUTCOMES`` (first matching condition)."""
    lv, m, nf, S, V, sf = map(_c, (level, months, size_f, size_status, sd_status, sd_f))
    mid = lv.isin("R2", "R3", "R4")
    middle = (m >= 18) & (m <= 42)
    old = m > 42
    revert = (nf == 2) & mid & (sf == 2)
    s0v0 = (S == 0) & (V == 0)
    conditions = [
        m < 18,
        middle & (S == 1) & (nf == 2),
        middle & (S == 1),
        middle & (S == 0) & (nf == 1),
        middle,
        old & (S == 1) & (V == 1) & revert,
        old & (S == 1) & (V == 0) & revert,
        old & (S == 0) & (V == 1) & revert,
        old & (((S == 1) & (V == 1)) | ((S == 1) & (V == 0)) | ((S == 0) & (V == 1))),
        old & s0v0 & (nf == 1) & mid & (sf == 1),
        old & s0v0 & (nf == 1),
        old & s0v0 & mid & (sf == 1),
    ]
    branch = F.when(conditions[0], 0)
    for i, cond in enumerate(conditions[1:], start=1):
        branch = branch.when(cond, i)
    return branch.otherwise(len(conditions))


def final_rating_outcome(branch, level) -> Column:
    """struct(level, reason, size_status, sd_status) for a branch of ``FINAL_OUTCOMES``;
    reason and statuses are null where the branch leaves them unchanged."""
    b, lv = _c(branch), _c(level)
    pick = b + 1

    def column(idx, dtype):
        return F.element_at(F.array(*[F.lit(o[idx]).cast(dtype) for o in FINAL_OUTCOMES]), pick)

    ups = [i for i, o in enumerate(FINAL_OUTCOMES) if o[0] == _UP]
    return F.struct(F.when(b.isin(ups), level_up(lv)).otherwise(lv).alias("level"),
                    column(1, "string").alias("reason"), column(2, "int").alias("size_status"),
                    column(3, "int").alias("sd_status"))


def final_rating(level, months, size_f, size_status, sd_status, sd_f) -> Column:
    """X6 -> struct(level, reason, size_status, sd_status) as one expression.

    Plans that use several fields should add ``final_rating_branch`` as a column
    first and derive the fields with ``final_rating_outcome`` (the conditions are
    then written once).
    """
    return final_rating_outcome(final_rating_branch(level, months, size_f, size_status, sd_status, sd_f), level)


FOLDED = "struct<level:string,reason:string,size_status:int,sd_status:int>"


def fold_ratings(records: Column, size_status: Column, sd_status: Column) -> Column:
    """X6 over an ordered array of records, each starting from the statuses the one before left.

    A record has level, months, size_flag, sd_flag, reason (kept where the rule sets none) and carried:
    whether the statuses of the record before hold for it (else its own size_status and sd_status are taken).
    ``size_status`` and ``sd_status`` come before the first record. Returns one struct (level, reason, size_status,
    sd_status) per record. Statuses are carried as the result table has them: null reads as 0."""
    state = F.struct(size_status.cast("int").alias("s"), sd_status.cast("int").alias("v"), F.array().cast(f"array<{FOLDED}>").alias("out"))

    def step(acc: Column, r: Column) -> Column:
        s, v = (F.when(r["carried"], acc[x]).otherwise(r[y]) for x, y in (("s", "size_status"), ("v", "sd_status")))
        note = final_rating(r["level"], r["months"], r["size_flag"], s, v, r["sd_flag"])
        out = F.struct(note["level"].alias("level"), F.coalesce(note["reason"], r["reason"]).alias("reason"),
                       F.coalesce(note["size_status"], s).alias("size_status"), F.coalesce(note["sd_status"], v).alias("sd_status"))
        return F.struct(F.coalesce(out["size_status"], F.lit(0)).alias("s"), F.coalesce(out["sd_status"], F.lit(0)).alias("v"),
                        F.concat(acc["out"], F.array(out)).alias("out"))

    return F.aggregate(records, state, step, lambda acc: acc["out"])


def change_direction(reason) -> Column:
    """-1 for a size or volatility revert, 1 for an uplift, else 0 (read from the reason text)."""
    r = _c(reason)
    return (F.when(r.contains(L.REASON_SIZE_UP), -1)
            .when(r.contains(L.REASON_SD_DOWN), -1)
            .when(r.contains(L.REASON_SIZE_DOWN), 1)
            .when(r.contains(L.REASON_SD_UP), 1)
            .otherwise(0))


# --- C17 / C19 -------------------------------------------------------------
def higher_level(a, b) -> Column:
    """The riskier of two R-codes; a null side yields the other (string order)."""
    return F.greatest(_c(a), _c(b))


def level_code(n) -> Column:
    """Integer 1..5 -> 'R1'..'R5', anything else null."""
    c = _c(n)
    expr = None
    for k in range(1, 6):
        expr = F.when(c == k, F.lit(f"R{k}")) if expr is None else expr.when(c == k, F.lit(f"R{k}"))
    return expr
