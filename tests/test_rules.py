"""Truth tables of the rating rules (expected values written from the method's rule tables)."""

import pytest

from riskladder.functions import lookups as L
from riskladder.functions import rules as R


def _eval(spark, rows, ddl, expr):
    df = spark.createDataFrame(rows, ddl)
    return [r[0] for r in df.select(expr.alias("o")).collect()]


# (level, months, size flag, size status, sd status, sd flag) -> (level, reason, size status, sd status)
FINAL_CASES = [
    (("R3", 17.97, 1, 0, 0, 1), ("R3", None, None, None)),
    (("R3", 18.0, 2, 1, 0, 0), ("R3", "规模上升", 0, 0)),
    (("R3", 18.0, 0, 1, 0, 0), ("R4", None, None, None)),
    (("R5", 30.0, 0, 1, None, 0), ("R5", None, None, None)),
    (("R2", 42.0, 1, 0, 1, 0), ("R3", "规模下降", 1, 0)),
    (("R2", 42.0, 0, 0, 0, 0), ("R2", None, None, None)),
    (("R2", 30.0, 1, None, None, 1), ("R2", None, None, None)),
    (("R3", 42.03, 2, 1, 1, 2), ("R3", "规模上升,波动率下降", 0, 0)),
    (("R3", 50.0, 2, 1, 0, 2), ("R3", "规模上升", 0, 0)),
    (("R3", 50.0, 2, 0, 1, 2), ("R3", "波动率下降", 0, 0)),
    (("R3", 50.0, 0, 1, 1, 2), ("R4", None, None, None)),
    (("R1", 50.0, 2, 1, 0, 2), ("R2", None, None, None)),
    (("R4", 50.0, 1, 0, 0, 1), ("R5", "规模下降,波动率上升", 1, 1)),
    (("R1", 50.0, 1, 0, 0, 1), ("R2", "规模下降", 1, 0)),
    (("R3", 50.0, 0, 0, 0, 1), ("R4", "波动率上升", 0, 1)),
    (("R3", 50.0, 0, 0, 0, 2), ("R3", None, None, None)),
    (("R3", 50.0, 1, None, 0, 1), ("R3", None, None, None)),
    ((None, 50.0, 1, 0, 0, 1), (None, "规模下降", 1, 0)),
    (("R3", None, 1, 0, 0, 1), ("R3", None, None, None)),
    (("R5", 50.0, 1, 0, 0, 0), ("R5", "规模下降", 1, 0)),
]


def test_final_rating_truth_table(spark):
    rows = [c[0] for c in FINAL_CASES]
    df = spark.createDataFrame(rows, "lv string, m double, nf int, s int, v int, sf int")
    out = df.select(R.final_rating("lv", "m", "nf", "s", "v", "sf").alias("n")).collect()
    got = [(r.n.level, r.n.reason, r.n.size_status, r.n.sd_status) for r in out]
    assert got == [c[1] for c in FINAL_CASES]


SIZE_CASES = [
    ((None, None, None, 999), 1), ((100, 100, 100, 1000), 1), ((4999, 4999, 4999, 4999), 1),
    ((5001, 5001, 5001, 5001), 2), ((5000, 5001, 5001, 5001), 0), ((6000, None, 6000, 6000), 0),
    ((None, None, None, None), 0), ((100, None, 100, 3000), 0), ((5001, 5001, 5001, 1000), 0),
]


def test_size_flag_truth_table(spark):
    from decimal import Decimal
    rows = [tuple(None if v is None else Decimal(v) for v in c[0]) for c in SIZE_CASES]
    got = _eval(spark, rows, "f decimal(38,9), t decimal(38,9), s decimal(38,9), l decimal(38,9)",
                R.size_flag("f", "t", "s", "l"))
    assert got == [c[1] for c in SIZE_CASES]


def test_sd_flag_truth_table(spark):
    rows = [(0.2, 0.2, 0.2, 0.2, 0.1), (0.1, 0.1, 0.1, 0.1, 0.1), (0.2, 0.1, 0.2, 0.2, 0.1),
            (None, 0.2, 0.2, 0.2, 0.1), (0.05, 0.05, None, 0.05, 0.1)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, std double")
    out = [r[0] for r in df.select(R.sd_flag(["a", "b", "c", "d"], ["std"] * 4)).collect()]
    assert out == [1, 2, 0, 0, 0]


# (name, code1, code2, level, share) -> (level, name1, name2, name3)
BASE_CASES = [
    (("任意", 15, 1510, "R2", None), ("R3", None, None, None)),
    ((None, 14, 1450, "R3", None), ("R3", None, None, None)),
    (("原油基金", 14, 1450, "R3", None), ("R5", "QDII基金", "商品QDII基金", "商品QDII基金（除黄金QDII）")),
    (("通胀QDII", 14, 1450, None, None), ("R5", "QDII基金", "商品QDII基金", "商品QDII基金（除黄金QDII）")),
    (("黄金QDII", 14, 1450, "R2", None), ("R3", "QDII基金", "商品QDII基金", "黄金QDII基金")),
    (("黄金QDII", 14, 1410, "R2", None), ("R2", None, None, None)),
    (("其他", 14, 1450, "R2", None), ("R2", None, None, None)),
    (("期货黄金", 17, 1710, "R3", None), ("R5", "商品基金", "商品基金", "商品基金（除黄金基金）")),
    (("上海金", 17, 1710, "R1", None), ("R3", "商品基金", "商品基金", "黄金基金")),
    (("可转换债券分级", 12, 1230, "R2", 1), ("R3", "债券基金", "债券分级子基金", "可转债分级子基金（优先份额）")),
    (("可转换债券分级", 12, 1230, "R2", 2), ("R5", "债券基金", "债券分级子基金", "可转债分级子基金（进取份额）")),
    (("债券分级", 12, 1230, "R2", 1), ("R3", "债券基金", "债券分级子基金", "普通债券分级子基金（优先份额）")),
    (("债券分级", 12, 1230, "R2", 2), ("R4", "债券基金", "债券分级子基金", "普通债券分级子基金（进取份额）")),
    (("债券分级", 12, 1230, "R2", None), ("R2", None, None, None)),
    (("可转换债券指数", 12, 1220, "R2", None), ("R3", "债券基金", "指数型债券基金", "可转债指数基金")),
    (("可转换债券指数", 12, 1210, "R2", None), ("R2", None, None, None)),
    ((None, 12, 1220, "R2", 1), ("R2", None, None, None)),
    (("原油", None, None, "R4", None), ("R4", None, None, None)),
    (("原油", 11, 1110, None, None), (None, None, None, None)),
]


def test_base_rule_truth_table(spark):
    rows = [c[0] for c in BASE_CASES]
    df = spark.createDataFrame(rows, "n string, c1 int, c2 int, lv string, sh int")
    out = df.select(R.base_risk_rule("n", "c1", "c2", "lv", "sh").alias("r")).collect()
    assert [(r.r.level, r.r.name1, r.r.name2, r.r.name3) for r in out] == [c[1] for c in BASE_CASES]


def test_special_rules_truth_table(spark):
    rows = [(None, "009697", "R2"), ("", "009697", "R2"), ("科技创新混合", "000001", "R2"),
            ("中航reit", "000001", "R2"), ("某基金", "009697", "R2"), ("某基金", "013867", "R2"),
            ("某基金", "014269", "R2"), ("同业存单AAA指数7天", "000001", "R3"), ("同业存单指数", "000001", "R3"),
            ("某基金", "000001", "R3"), ("某基金", None, "R3")]
    df = spark.createDataFrame(rows, "n string, code string, lv string")
    q = [r[0] for r in df.select(R.special_rule_quarterly("n", "code", "lv")).collect()]
    assert q == ["R2", "R2", "R4", "R4", "R3", "R4", "R4", "R3", "R3", "R3", "R3"]
    d = [(r.x.level, r.x.special) for r in df.select(R.special_rule_daily("n", "code", "lv").alias("x")).collect()]
    assert d == [("R2", None), ("R2", None), ("R4", 1), ("R4", 2), ("R3", 3), ("R4", 3), ("R4", 4),
                 ("R1", None), ("R2", None), ("R3", None), ("R3", None)]


def test_code_lists_are_disjoint_and_complete():
    assert len(L.NEEQ_R3) == 26 and len(L.NEEQ_R4) == 7 and len(L.BEIJING_R4) == 22
    assert not set(L.NEEQ_R3) & set(L.QUARTERLY_R4)
    assert len(set(L.QUARTERLY_R4)) == 29
    assert len(L.BASIC_RISK_LEVEL) == 47
    assert len({r[:3] for r in L.BASIC_RISK_LEVEL}) == 47


def test_labels_codes_and_higher_level(spark):
    rows = [("R1", 1, "R3", None), ("R5", 5, None, "R2"), (None, 6, None, None), ("R6", None, "R2", "R4")]
    df = spark.createDataFrame(rows, "lv string, n int, a string, b string")
    out = df.select(L.level_label("lv").alias("l"), R.level_code("n").alias("c"),
                    R.higher_level("a", "b").alias("h"), R.level_up("lv").alias("u")).collect()
    assert [tuple(r) for r in out] == [("低", "R1", "R3", "R2"), ("高", "R5", "R2", "R5"),
                                       ("未知", None, None, None), (None, None, "R4", "R5")]


def test_conversion_remark_and_direction(spark):
    df = spark.createDataFrame([("股票FOF",), ("",), (None,)], "p string")
    assert [r[0] for r in df.select(R.conversion_remark("p")).collect()] == ["由股票FOF转型而来", None, None]
    d2 = spark.createDataFrame([("规模上升",), ("规模下降,波动率上升",), ("波动率下降",), ("由X转型而来",), (None,)], "r string")
    assert [r[0] for r in d2.select(R.change_direction("r")).collect()] == [-1, 1, -1, 0, 0]


@pytest.mark.parametrize("words", [("FOF", "股票FOF")])
def test_fof_rename_reads_level_one_name(spark, words):
    from riskladder.plans.quarterly import fof_names
    df = spark.createDataFrame([("FOF", "股票FOF", "股票FOF"), ("债券基金", "纯债", "纯债基金")], "FundTypeName1 string, FundTypeName2 string, FundTypeName3 string")
    out = [tuple(r) for r in fof_names(df).collect()]
    assert out == [("FOF", "股票股票FOF", "股票FOF"), ("债券基金", "纯债", "纯债基金")]
