"""Registered queries: every operator of the rating method run on the driver's tables.

Each query takes (spark, sf_dir) and reads whole tables. Standard deviations come from exact
moments, so nothing is rounded for the comparison.
The SQL twin of each query is in ``riskladder.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskladder.functions import calendar as C
from riskladder.functions import lookups as L
from riskladder.functions import rules as R
from riskladder.operators import asof, benchmark, hierarchy, joins, propagate, returns, sizing
from riskladder.plans import daily, history, master as master_plan, quarterly
from riskladder.session import ensure_checkpoint_dir, materialize
from riskladder.sources import readers, schemas
from riskladder.sources import standins as S
from riskladder.sources.local import local_table

AS_OF = dt.date(2001, 2, 15)
DATES = C.rating_dates(AS_OF)
HISTORY = [dt.date(2000, 5, 15), dt.date(2000, 8, 15), dt.date(2000, 11, 15), AS_OF]
EVENT_CUT = dt.date(2024, 1, 20)

# English words of part names -> rule keywords (stand-in for fund names)
WORD_KEYWORDS = {
    "red": "原油", "blue": "商品", "hot": "黄金", "old": "期货", "new": "上海金",
    "large": "可转换债券", "small": "分级", "ring": "reit", "widget": "科创", "bolt": "科技创新",
    "gear": "通胀", "gizmo": "同业存单", "plate": "同业存单AAA指数7天", "anvil": "基金",
}
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def lookup_rows() -> list[tuple[str, str, str, str]]:
    """Three-key stand-in config: nations 0..14 x segments BUILDING/MACHINERY."""
    rows = []
    for n in range(15):
        for j, seg in enumerate(("BUILDING", "MACHINERY")):
            rows.append((REGIONS[n % 5], f"NATION_{n}", seg, f"R{1 + (n + j) % 5}"))
    return rows


def _t(spark, sf_dir, name):
    return S.load(spark, sf_dir, name)


def _sd_cols(suffix: str = "QrtSD") -> list[str]:
    return [f"{q}{suffix}" for q in C.QUARTER_LABELS]


def fund_name(name: Column) -> Column:
    """Translate the words of a part name to rule keywords and glue them together."""
    def tr(w):
        e = None
        for en, zh in WORD_KEYWORDS.items():
            e = F.when(w == en, F.lit(zh)) if e is None else e.when(w == en, F.lit(zh))
        return e.otherwise(w)
    return F.array_join(F.transform(F.split(name, " "), tr), "")


def part_funds(spark, sf_dir) -> DataFrame:
    """Parts as funds: name, code, base level, type codes and tranche."""
    k = F.col("p_partkey")
    code1 = F.element_at(F.array(*[F.lit(c) for c in (12, 14, 15, 17, 11)]), (F.col("p_size") % 5 + 1).cast("int"))
    return _t(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", "p_brand", "p_size",
        fund_name(F.col("p_name")).alias("ChiName"),
        F.lpad(((k * 37) % 15000).cast("string"), 6, "0").alias("SecurityCode"),
        F.concat(F.lit("R"), (F.col("p_size") % 5 + 1).cast("string")).alias("BaseLevel"),
        code1.alias("FundTypeCode1"),
        F.when((code1 == 14) & (k % 2 == 0), 1450).when(code1 == 14, 1410)
         .when((code1 == 12) & (k % 2 == 0), 1220).when(code1 == 12, 1230)
         .otherwise(code1 * 100 + 10).alias("FundTypeCode2"),
        F.when(k % 3 == 0, 1).when(k % 3 == 1, 2).alias("ShareProperties"))


def _scratch(spark) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/riskladder-{uuid.uuid4().hex}"


# --- extracts as CSV: a table is written as an extract and read back by the readers ----
def _as_extract(df, name: str):
    schema, _ = schemas.EXTRACTS[name]
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def q_csv_headerless(spark, sf_dir):
    path = _scratch(spark)
    _as_extract(S.mainfinancialindex(spark, sf_dir), "mainfinancialindex").write.csv(path)
    return readers.read_extract(spark, "mainfinancialindex", path)


def q_csv_two_headers(spark, sf_dir):
    """One folder, files with two column orders and an extra column in one of them."""
    path = _scratch(spark)
    rows = _as_extract(S.unitnvrestored(spark, sf_dir), "unitnvrestored")
    odd = F.col("InnerCode") % 2 == 1
    rows.filter(odd).write.option("header", True).csv(path)
    turned = rows.filter(~odd).select(*reversed(rows.columns), F.lit("x").alias("Extra"))
    turned.select("Extra", *turned.columns[:-1]).write.mode("append").option("header", True).csv(path)
    return readers.read_extract(spark, "unitnvrestored", path).drop("UnitNVRestored")


def q_csv_cp936(spark, sf_dir):
    """Chinese names in a legacy charset, a setting of the session that holds while the file is read. An empty
    field of a CSV file is null."""
    path, key = _scratch(spark), "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        _as_extract(S.secumain(spark, sf_dir), "secumain").write.option("encoding", "cp936").csv(path)
        return materialize(readers.read_extract(spark, "secumain", path, encoding="cp936"))
    finally:
        spark.conf.set(key, before)


# --- scans and projections -------------------------------------------------
def q_scan_schema(spark, sf_dir):
    return (spark.read.schema("c_custkey bigint, c_name string, c_mktsegment string")
            .parquet(f"{sf_dir}/customer.parquet"))


def q_project_alias(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("cust_id"),
        F.to_date("o_orderdate").alias("order_day"), (F.col("o_totalprice") / 10000).alias("price_10k"))


def q_rename_drop(spark, sf_dir):
    return (_t(spark, sf_dir, "part").drop("p_retailprice")
            .withColumnsRenamed({"p_partkey": "PartCode", "p_name": "PartName", "p_type": "PartType"}))


def q_const_null_cols(spark, sf_dir):
    return _t(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.lit(2).alias("RLDivisionMode"),
        F.lit(None).cast("string").alias("Remark"), F.lit(None).cast("long").alias("JSID"),
        F.lit(DATES.d1).alias("EndDate"), F.lit(AS_OF).alias("UpdateTime"))


def q_fill_zero(spark, sf_dir):
    o = (_t(spark, sf_dir, "orders").groupBy("o_custkey")
         .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total_price"),
              F.count(F.lit(1)).alias("n_orders")))
    c = _t(spark, sf_dir, "customer")
    return (c.join(o, c["c_custkey"] == o["o_custkey"], "left")
             .select("c_custkey", "total_price", "n_orders")
             .na.fill(0, subset=["total_price", "n_orders"]))


# --- filters ---------------------------------------------------------------
def q_filter_in(spark, sf_dir):
    return (_t(spark, sf_dir, "customer")
            .filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & F.col("c_nationkey").isin(1, 3, 9))
            .select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))


def q_filter_neq_null(spark, sf_dir):
    c, o = _t(spark, sf_dir, "customer"), _t(spark, sf_dir, "orders")
    return (c.join(o, c["c_custkey"] == o["o_custkey"], "left")
             .filter(F.col("o_orderpriority") != "5-LOW")
             .select("c_custkey", "o_orderkey", "o_orderpriority"))


def q_alive_at(spark, sf_dir):
    spans = (_t(spark, sf_dir, "orders").groupBy("o_custkey")
             .agg(F.min(F.to_date("o_orderdate")).alias("start_day"), F.max(F.to_date("o_orderdate")).alias("_last")))
    spans = spans.withColumn("end_day", F.when(F.col("o_custkey") % 3 != 0, F.col("_last"))).drop("_last")
    return spans.filter(asof.alive_at("start_day", "end_day", DATES.d1))


def q_range_windows(spark, sf_dir):
    day = F.to_date("l_shipdate")
    counts = _t(spark, sf_dir, "lineitem").agg(
        *[F.count(F.when(C.in_window(day, lo, hi), 1)).alias(lab) for lab, lo, hi in DATES.vol_windows])
    rows = [F.struct(F.lit(lab).alias("qrt_window"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"),
                     F.col(lab).alias("n_rows")) for lab, lo, hi in DATES.vol_windows]
    return counts.select(F.inline(F.array(*rows)))


# --- as-of / top-1 ---------------------------------------------------------
def _events_asof(spark, sf_dir):
    return asof.effective_at(_t(spark, sf_dir, "events").withColumn("_day", F.to_date("ts")), "_day", EVENT_CUT)


def q_asof_latest(spark, sf_dir):
    latest = asof.latest_per_key(_events_asof(spark, sf_dir), "user_id", ["ts"], ["event_id", "event_type"])
    return latest.filter(~F.col("event_type").startswith("err"))


def q_asof_latest_rating(spark, sf_dir):
    latest = asof.latest_per_key(_events_asof(spark, sf_dir), "user_id", ["ts"], ["event_id", "value"])
    return latest.select("user_id", R.level_code(F.floor(F.col("value") / 80) + 1).alias("OfficialRiskLevel"))


def q_latest_batch(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_day"), "o_orderpriority")
    return asof.latest_batch(o, "order_day", "o_orderpriority")


ASOF_DATES = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in (-30, *range(0, 54, 3), 400)]


def q_asof_dates(spark, sf_dir):
    """The latest event of every user at twenty dates, in one pass."""
    ev = _t(spark, sf_dir, "events").withColumn("_day", F.to_date("ts"))
    return asof.latest_at_dates(ev, "user_id", "_day", ASOF_DATES, ["ts"], ["event_id", "event_type"])


# --- joins -----------------------------------------------------------------
def _cust_orders(spark, sf_dir, how):
    c = _t(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "custkey")
    o = _t(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")
    return c.join(o, "custkey", how).select("custkey", "c_name", "o_orderkey", "o_totalprice")


def q_join_left(spark, sf_dir):
    return _cust_orders(spark, sf_dir, "left")


def q_join_inner(spark, sf_dir):
    return _cust_orders(spark, sf_dir, "inner")


def q_join_left_renamed(spark, sf_dir):
    s, n = _t(spark, sf_dir, "supplier"), _t(spark, sf_dir, "nation")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"], "left").select("s_suppkey", "s_name", "n_name")


def q_join_anti(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("_day", F.to_date("o_orderdate"))
    newest = o.select(F.max("_day")).scalar()
    recent = o.filter(F.col("_day") > F.add_months(newest, -12))
    c = _t(spark, sf_dir, "customer")
    return c.join(recent, c["c_custkey"] == recent["o_custkey"], "left_anti").select("c_custkey", "c_name")


def q_hierarchy_join(spark, sf_dir):
    return hierarchy.flatten_tree(_places(spark, sf_dir))


def q_hierarchy_paths(spark, sf_dir):
    """The same tree by the recursive query."""
    return hierarchy.flatten_paths(_places(spark, sf_dir))


def _places(spark, sf_dir):
    r = _t(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("long").alias("FundTypeCode"), F.col("r_name").alias("FundTypeName"),
        F.lit(0).cast("long").alias("FNodeCode"), F.lit(1).alias("Level"), F.lit(1).alias("IfExecuted"))
    n = _t(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1000).cast("long").alias("FundTypeCode"), F.col("n_name").alias("FundTypeName"),
        F.col("n_regionkey").cast("long").alias("FNodeCode"), F.lit(2).alias("Level"),
        F.when(F.col("n_nationkey") % 7 == 3, 0).otherwise(1).alias("IfExecuted"))
    s = _t(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 100000).alias("FundTypeCode"), F.col("s_name").alias("FundTypeName"),
        (F.col("s_nationkey") + 1000).cast("long").alias("FNodeCode"), F.lit(3).alias("Level"), F.lit(1).alias("IfExecuted"))
    return r.unionByName(n).unionByName(s)


def q_lookup_three_key(spark, sf_dir):
    conf = local_table(spark, lookup_rows(), "r_name string, n_name string, c_mktsegment string, RiskLevel string")
    c, n, r = _t(spark, sf_dir, "customer"), _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region")
    base = (c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
             .select("c_custkey", "r_name", "n_name", "c_mktsegment"))
    return joins.left_lookup(base, conf, ["r_name", "n_name", "c_mktsegment"])


def q_conversion_join(spark, sf_dir):
    arch = S.fundarchives(spark, sf_dir).join(
        S.secumain(spark, sf_dir).select("InnerCode", F.col("SecuAbbr").alias("FundTypeName3")), "InnerCode")
    out = joins.attach_predecessor(arch, joins.predecessors(arch, DATES.d2))
    return out.select("InnerCode", "MainCode", "SecurityCode", "PreviousFundTypeName3",
                      R.conversion_remark("PreviousFundTypeName3").alias("ChangeReason"))


# --- size ------------------------------------------------------------------
def _orders_nav(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("EndDate"),
        F.col("o_totalprice").cast("decimal(18,3)").alias("NetAssetsValue"))


def q_nav_sum(spark, sf_dir):
    return sizing.nav_sum(_orders_nav(spark, sf_dir), DATES, key="o_custkey")


def q_nav_pivot(spark, sf_dir):
    return sizing.nav_by_quarter(_orders_nav(spark, sf_dir), DATES, key="o_custkey")


def q_size_flag(spark, sf_dir):
    nv = sizing.nav_by_quarter(S.mainfinancialindex(spark, sf_dir), DATES, key="InnerCode")
    return nv.withColumn("NetAssetFlag", R.size_flag("ForthQrtNV", "ThirdQrtNV", "SecondQrtNV", "LastQrtNV"))


# --- dates -----------------------------------------------------------------
def q_week_bucket(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("TradingDay"),
        C.week_number(F.to_date("l_shipdate")).alias("weekNum"))


def q_date_parts(spark, sf_dir):
    d = F.to_date("o_orderdate")
    return _t(spark, sf_dir, "orders").select(
        "o_orderkey", d.alias("order_day"), F.date_sub(d, 1).alias("day_before"),
        F.add_months(d, -12).alias("year_before"), F.lit(DATES.d1).alias("EndDate"),
        F.lit(AS_OF).alias("UpdateTime"))


def q_tenure_months(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select(
        "o_orderkey", C.tenure_months(DATES.d1, F.to_date("o_orderdate")).alias("EstablishmentLength"))


def q_quarter_ends(spark, sf_dir):
    d = F.to_date("o_orderdate")
    cols = {f"d{k + 1}": C.quarter_end_before(d, k) for k in range(4)}
    out = _t(spark, sf_dir, "orders").select("o_orderkey", d.alias("order_day"), *[v.alias(k) for k, v in cols.items()])
    return out.withColumns({"d5": F.add_months("d1", -12), "d6": F.add_months("d1", -36), "d7": F.add_months("d2", -36),
                            "d8": F.add_months("d3", -36), "d9": F.add_months("d4", -36)})


# --- returns and volatility ------------------------------------------------
def q_weekly_return(spark, sf_dir):
    return returns.weekly_returns(S.unitnvrestored(spark, sf_dir), "InnerCode", "TradingDay", "NVRDailyGrowthRate")


def q_volatility_1q(spark, sf_dir):
    return returns.volatility_window(S.unitnvrestored(spark, sf_dir), DATES.d6, DATES.d1, "LastQrtSD")


def q_volatility_4q(spark, sf_dir):
    return returns.volatility_quarters(S.unitnvrestored(spark, sf_dir), DATES)


def q_volatility_incremental(spark, sf_dir):
    """The four windows from stored weekly states: earlier quarters are in the store, the new one is added."""
    series, path = S.unitnvrestored(spark, sf_dir), _scratch(spark)
    returns.store_states(series, path, DATES.d9, DATES.d2)
    returns.store_states(series, path, DATES.d2, DATES.d1)
    return returns.volatility_from_states(spark, path, DATES)


def q_volatility_history(spark, sf_dir):
    """The four windows of every run in ``HISTORY`` in one pass."""
    return returns.volatility_history(S.unitnvrestored(spark, sf_dir), [C.rating_dates(d) for d in HISTORY])


def _index_series(spark, sf_dir):
    return S.index_quotes(spark, sf_dir)


def q_union_series(spark, sf_dir):
    return _index_series(spark, sf_dir)


def _index_vol(spark, sf_dir):
    return returns.volatility_quarters(_index_series(spark, sf_dir), DATES, rate="ChangePCT")


def q_benchmark_row(spark, sf_dir):
    return benchmark.benchmark_row(_index_vol(spark, sf_dir))


def _fund_factors(spark, sf_dir):
    vol = returns.volatility_quarters(S.unitnvrestored(spark, sf_dir), DATES)
    bench = benchmark.benchmark_scalar(_index_vol(spark, sf_dir))
    df = vol.withColumn("level", F.concat(F.lit("R"), (F.col("InnerCode") % 5 + 1).cast("string")))
    df = benchmark.with_benchmark(df, bench)
    return df.withColumns(benchmark.factors_and_standards(F.col("level"), F.col("_bench"))).drop("_bench")


def q_sd_factor(spark, sf_dir):
    cols = _sd_cols("QrtSDFactor") + _sd_cols("QrtStandard")
    return _fund_factors(spark, sf_dir).select("InnerCode", "level", *cols)


def q_sd_flag(spark, sf_dir):
    df = _fund_factors(spark, sf_dir)
    return df.select("InnerCode", "level", R.sd_flag(_sd_cols(), _sd_cols("QrtStandard")).alias("SDFlag"))


# --- rules -----------------------------------------------------------------
def q_keyword_cascade(spark, sf_dir):
    pf = part_funds(spark, sf_dir)
    name = F.col("ChiName")
    kind = (F.when(name.contains("原油") | name.contains("商品") | name.contains("通胀"), "commodity")
             .when(name.contains("黄金") | name.contains("上海金"), "gold")
             .when(name.contains("期货"), "futures")
             .when(name.contains("科创") | name.contains("科技创新"), "sci-tech")
             .when(F.upper(name).contains("REIT"), "reit")
             .when(name.contains("同业存单"), "cd")
             .otherwise("other"))
    return pf.select("p_partkey", "ChiName", kind.alias("keyword_class"))


def q_normalise_names(spark, sf_dir):
    names1 = ["债券基金", "股票基金", "FOF", "混合基金"]
    names2 = ["指数型债券基金", "股票FOF", "主动投资混合基金", "指数型股票基金", "FOF"]
    names3 = ["股票FOF", "普通股票基金", "其他FOF", "纯债基金"]
    k = F.col("p_partkey")
    df = _t(spark, sf_dir, "part").select(
        "p_partkey",
        F.element_at(F.array(*map(F.lit, names1)), (k % 4 + 1).cast("int")).alias("FundTypeName1"),
        F.element_at(F.array(*map(F.lit, names2)), (k % 5 + 1).cast("int")).alias("FundTypeName2"),
        F.element_at(F.array(*map(F.lit, names3)), (F.col("p_size") % 4 + 1).cast("int")).alias("FundTypeName3"))
    df = df.withColumns({
        "FundTypeName2": quarterly._replace_if("FundTypeName2", "指数型", "指数"),
        "FundTypeName1": quarterly._replace_if("FundTypeName1", "债券基金", "债券基金（不含封闭式）"),
    })
    return quarterly.fof_names(df)


def q_unpack_rule_struct(spark, sf_dir):
    pf = part_funds(spark, sf_dir)
    x3 = R.special_rule_daily("ChiName", "SecurityCode", "BaseLevel")
    return (pf.withColumn("_x3", x3)
              .select("p_partkey", F.col("_x3.level").alias("BasicRiskLevel"),
                      F.col("_x3.special").alias("SpecialType")))


def q_bucket_case(spark, sf_dir):
    d = F.to_date("o_orderdate")
    return (_t(spark, sf_dir, "orders").filter(C.in_window(d, DATES.d5, DATES.d1))
            .select("o_orderkey", sizing.quarter_label(d, DATES).alias("Qrt")))


def q_code_list_override(spark, sf_dir):
    pf = part_funds(spark, sf_dir)
    return pf.select("p_partkey", "SecurityCode", "ChiName", "BaseLevel",
                     R.special_rule_quarterly("ChiName", "SecurityCode", "BaseLevel").alias("InitRiskLevel"))


def q_special_rule_daily(spark, sf_dir):
    pf = part_funds(spark, sf_dir)
    x3 = R.special_rule_daily("ChiName", "SecurityCode", "BaseLevel")
    return pf.select("p_partkey", "SecurityCode", x3["level"].alias("BasicRiskLevel"), x3["special"].alias("SpecialType"))


def q_base_risk_rule(spark, sf_dir):
    pf = part_funds(spark, sf_dir).withColumns({
        "FundTypeName1": F.col("p_type"), "FundTypeName2": F.col("p_brand"), "FundTypeName3": F.col("p_name")})
    out = R.apply_base_rule(pf, "BaseLevel", "InitRiskLevel")
    return out.select("p_partkey", "InitRiskLevel", "FundTypeName1", "FundTypeName2", "FundTypeName3")


def q_final_rating(spark, sf_dir):
    k = F.col("o_orderkey")
    df = _t(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(k % 6 != 5, F.concat(F.lit("R"), (k % 6 + 1).cast("string"))).alias("level"),
        C.tenure_months(DATES.d1, F.to_date("o_orderdate")).alias("months"),
        (k % 3).cast("int").alias("NetAssetFlag"),
        F.when(k % 7 != 0, (k % 7 % 2).cast("int")).alias("FundSizeStatus"),
        F.when(k % 11 != 0, (k % 11 % 2).cast("int")).alias("SDStatus"),
        (k % 13 % 3).cast("int").alias("SDFlag"))
    branch = R.final_rating_branch("level", "months", "NetAssetFlag", "FundSizeStatus", "SDStatus", "SDFlag")
    out = df.withColumn("_b", branch).withColumn("_n", R.final_rating_outcome("_b", "level")).select(
        "o_orderkey", F.col("_n.level").alias("RiskLevel"), F.col("_n.reason").alias("ChangeReason"),
        F.coalesce(F.col("_n.size_status"), F.col("FundSizeStatus")).alias("FundSizeStatus"),
        F.coalesce(F.col("_n.sd_status"), F.col("SDStatus")).alias("SDStatus"))
    return out.withColumn("ChangeDirection", R.change_direction("ChangeReason"))


def q_state_fold(spark, sf_dir):
    """The state machine folded over every customer's quarters (the newest order of each) in order."""
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    record = F.struct(
        day.alias("day"), k.alias("id"),
        F.when(k % 6 != 5, F.concat(F.lit("R"), (k % 6 + 1).cast("string"))).alias("level"),
        C.tenure_months(AS_OF, day).alias("months"), (k % 3).cast("int").alias("size_flag"),
        (k % 13 % 3).cast("int").alias("sd_flag"), F.lit(None).cast("string").alias("reason"), (k % 10 != 0).alias("carried"),
        F.lit(0).alias("size_status"), (k % 20 / 10).cast("int").alias("sd_status"))
    newest = _t(spark, sf_dir, "orders").groupBy("o_custkey", F.trunc(day, "quarter").alias("q")).agg(F.max(record).alias("r"))
    rows = newest.groupBy("o_custkey").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    out = rows.select("o_custkey", F.explode(F.arrays_zip("rs", R.fold_ratings(F.col("rs"), F.lit(0), F.lit(0)).alias("out"))).alias("x"))
    return out.select("o_custkey", F.col("x.rs.id").alias("o_orderkey"), F.col("x.out.level").alias("RiskLevel"),
                      F.col("x.out.reason").alias("ChangeReason"), F.col("x.out.size_status").alias("FundSizeStatus"),
                      F.col("x.out.sd_status").alias("SDStatus"))


def q_propagate_main(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("MainCode"),
        F.when(F.col("p_type") == "STANDARD", 1).otherwise(2).alias("IsMain"),
        F.when(F.col("p_size") % 7 != 0, F.concat(F.lit("R"), (F.col("p_size") % 5 + 1).cast("string"))).alias("RiskLevel"),
        F.col("p_name").alias("ChangeReason"))
    return propagate.propagate_first(p, "MainCode", ["IsMain", "p_partkey"], ["RiskLevel", "ChangeReason"])


def _two_levels(spark, sf_dir):
    def lv(c):
        return F.when(c % 6 != 5, F.concat(F.lit("R"), (c % 6 + 1).cast("string")))
    return _t(spark, sf_dir, "orders").select(
        "o_orderkey", lv(F.col("o_orderkey")).alias("RiskLevel"), lv(F.col("o_custkey")).alias("OfficialRiskLevel"))


def q_higher_level(spark, sf_dir):
    return _two_levels(spark, sf_dir).withColumn("HigherRiskLevel", R.higher_level("RiskLevel", "OfficialRiskLevel"))


def q_level_label(spark, sf_dir):
    return _two_levels(spark, sf_dir).select(
        "o_orderkey", L.level_label("RiskLevel").alias("RiskLevelName"),
        L.level_label("OfficialRiskLevel").alias("OfficialRiskLevelName"))


# --- end to end ------------------------------------------------------------
MASTER_COLUMNS = ["InnerCode", "ChiName", "SecuAbbr", "SecuCategory", "ListedState", "MainCode", "SecurityCode",
                  "ApplyingCodeFront", "ApplyingCodeBack", "EstablishmentDate", "EstablishmentDateII",
                  "ShareProperties", "ExpireDate", "FundTypeCode3", "FundTypeCode1", "FundTypeName1",
                  "FundTypeCode2", "FundTypeName2", "FundTypeName3", "OfficialRiskLevel"]
BASE_COLUMNS = MASTER_COLUMNS + ["RiskLevel", "InitRiskLevel", "PreviousFundTypeName3", "MainCodeJ",
                                 "ExpireDateJ", "MainCodeJoin", "ChangeReason"]


def _master(spark, sf_dir, type_as_of):
    t = S.fund_tables(spark, sf_dir)
    return master_plan.build_master(t["secumain"], t["fundarchives"], t["fundtype"], t["fundrisklevel"],
                                    t["fundtypechangenew"], DATES.d1, type_as_of)


def q_master(spark, sf_dir):
    return _master(spark, sf_dir, DATES.d1).select(*MASTER_COLUMNS)


def q_rating_base(spark, sf_dir):
    base = quarterly.base_rating_quarterly(_master(spark, sf_dir, DATES.d1), L.risk_mapping(spark), DATES)
    return base.select(*BASE_COLUMNS)


def q_rating_daily(spark, sf_dir):
    return daily.run_daily(S.fund_tables(spark, sf_dir), AS_OF, L.risk_mapping(spark, "InitialRiskLevel"),
                           S.fundtyperisklevel(spark))


def q_rating_daily_uncut(spark, sf_dir):
    """The daily rating as the original job ran it: newest type even if it starts later."""
    return daily.run_daily(S.fund_tables(spark, sf_dir), AS_OF, L.risk_mapping(spark, "InitialRiskLevel"),
                           S.fundtyperisklevel(spark), cut_type_history=False)


def q_rating_quarterly(spark, sf_dir):
    return quarterly.run_quarterly(S.fund_tables(spark, sf_dir), AS_OF, L.risk_mapping(spark))


def q_rating_history(spark, sf_dir):
    """The quarterly ratings of several quarters in one job, each from the statuses the one before left."""
    return history.run_history(S.fund_tables(spark, sf_dir), HISTORY, L.risk_mapping(spark))


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)}
