"""Many dates, quarters and levels at once: each against the single run it replaces."""

import datetime as dt
import fractions
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from riskladder.functions import lookups as L
from riskladder.functions import rules as R
from riskladder.functions.calendar import rating_dates
from riskladder.operators import asof, hierarchy, returns, sizing
from riskladder.plans import catalog
from riskladder.plans.history import run_history
from riskladder.plans.quarterly import run_quarterly
from riskladder.session import materialize
from riskladder.sources import standins

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_many_dates_equal_single_runs(spark):
    r = random.Random(1)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(days=r.randrange(60))
    rows = [(r.choice([1, 1, 1, 2, 3, None]), r.choice([None, day(), day(), day()]), r.choice([None, "a", "b"]), r.randrange(3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "k int, d date, x string, y int").repartition(3)
    dates = [dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(-5, 70, 4)]
    got = asof.latest_at_dates(df, "k", "d", [*dates, dates[3]], ["d"], ["y", "x"])
    want = [(k, x, *rest) for x in dates
            for k, *rest in rows_of(asof.latest_per_key(asof.effective_at(df, "d", x), "k", ["d"], ["y", "x"]))]
    assert rows_of(got) == sorted(want, key=repr) and want
    plan = plan_of(got)
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert asof.latest_at_dates(df.limit(0), "k", "d", dates, ["d"], ["x"]).count() == 0
    assert asof.latest_at_dates(df, "k", "d", [], ["d"], ["x"]).count() == 0


def test_history_equals_chained_single_runs(spark):
    as_ofs = [dt.date(2000, 5, 15), dt.date(2000, 8, 15), dt.date(2000, 9, 1), dt.date(2001, 2, 15)]     # one quarter twice, one missing
    t = standins.fund_tables(spark, SF)
    got = run_history(t, as_ofs, L.risk_mapping(spark))
    want, before = [], None
    for a in (as_ofs[0], as_ofs[2], as_ofs[3]):
        dates = rating_dates(a)
        last = t["last_qrt"]
        if before is not None:
            last = before[1].select("InnerCode", "FundSizeStatus", "SDStatus")
            if before[0] != dates.d2:
                last = last.limit(0)
        out = materialize(run_quarterly(t | {"last_qrt": last}, a, L.risk_mapping(spark)))
        before = dates.d1, out
        want += rows_of(out.select(*got.columns))
    assert rows_of(got) == sorted(want, key=repr) and len(want) > 8
    assert got.dtypes == out.select(*got.columns).dtypes


def test_fold_is_a_chain_of_single_steps(spark):
    r = random.Random(2)
    pick = lambda *x: r.choice(x)
    funds = [[(pick("R1", "R2", "R3", "R4", "R5", None), float(pick(10, 18, 30, 42, 43, 60)), pick(0, 1, 2), pick(0, 1, 2), pick(None, "why"),
               pick(True, True, False), pick(0, 1, None), pick(0, 1, None)) for _ in range(pick(1, 3, 8))] for _ in range(60)]
    shape = "level string, months double, size_flag int, sd_flag int, reason string, carried boolean, size_status int, sd_status int"
    df = spark.createDataFrame(list(enumerate(funds)), f"i int, rs array<struct<{shape.replace(' ', ':').replace(',:', ',')}>>")
    folded = {x.i: x.out for x in df.select("i", R.fold_ratings(F.col("rs"), F.lit(1), F.lit(0)).alias("out")).collect()}
    flat = spark.createDataFrame([(i, k, *f[k][:4], s, v) for i, f in enumerate(funds) for k in range(len(f)) for s in (0, 1, None) for v in (0, 1, None)],
                                 "i int, k int, level string, months double, size_flag int, sd_flag int, s int, v int")
    one = flat.select("i", "k", "s", "v", R.final_rating("level", "months", "size_flag", "s", "v", "sd_flag").alias("n"))
    single = {(x.i, x.k, x.s, x.v): x.n for x in one.collect()}
    for i, f in enumerate(funds):
        s, v = 1, 0
        for k, rec in enumerate(f):
            s, v = (s, v) if rec[5] else rec[6:]
            n, got = single[(i, k, s, v)], folded[i][k]
            s, v = (n.size_status if n.size_status is not None else s), (n.sd_status if n.sd_status is not None else v)
            assert tuple(got) == (n.level, n.reason or rec[4], s, v)
            s, v = s or 0, v or 0


def test_exact_deviation(spark):
    r = random.Random(3)
    groups = {g: [round(r.uniform(-1, 1) * 10 ** r.randint(-4, 2), 6) for _ in range(r.choice([0, 1, 2, 50, 160]))] for g in range(40)}
    groups[100] = [0.123456] * 30                  # no spread at all
    groups[101] = [999999999.999999, -999999999.999999, 5.0]
    rows = [(g, str(x)) for g, xs in groups.items() for x in xs] + [(0, None)]
    df = spark.createDataFrame(rows, "g int, x string").select("g", F.col("x").cast("decimal(18,6)").alias("x"))
    seen = set()
    for n in (1, 3, 7):
        got = {x.g: x.sd for x in df.repartition(n, F.rand(n)).groupBy("g").agg(returns.sample_sd("x").alias("sd")).collect()}
        seen.add(tuple(sorted(got.items(), key=repr)))
    assert len(seen) == 1                          # bit for bit, however the rows are dealt
    for g, xs in groups.items():
        if len(xs) < 2:
            assert got.get(g) is None
            continue
        q = [fractions.Fraction(f"{x:.6f}") for x in xs]
        var = (len(q) * sum(x * x for x in q) - sum(q) ** 2) / (len(q) * (len(q) - 1))
        assert got[g] == pytest.approx(math.sqrt(var), rel=1e-15, abs=0)
    assert got[100] == 0.0
    huge = spark.createDataFrame([("999999999999",), ("-999999999999",), ("1",)], "x string").select(F.col("x").cast("decimal(18,6)").alias("x"))
    assert huge.agg(returns.sample_sd("x")).first()[0] == pytest.approx(999999999999.0, rel=1e-9)


def test_volatility_from_stored_states(spark, tmp_dir):
    path = os.path.join(tmp_dir, "states")
    series, dates = standins.unitnvrestored(spark, SF), catalog.DATES
    wrong = series.withColumn("NVRDailyGrowthRate", F.lit(9).cast("decimal(18,8)"))
    returns.store_states(series, path, dates.d9, dates.d2)
    returns.store_states(wrong, path, dates.d2, dates.d1)
    returns.store_states(series, path, dates.d2, dates.d1)       # the correction replaces the quarter
    want = rows_of(returns.volatility_quarters(series, dates))
    assert rows_of(returns.volatility_from_states(spark, path, dates)) == want and want
    assert spark.read.parquet(path).select("quarter").distinct().count() <= 16
    # the next quarter reads its own rows and, of the store, the quarters of its windows
    stored = materialize(series.select("InnerCode", "TradingDay", "NVRDailyGrowthRate"))
    stored.write.parquet(os.path.join(tmp_dir, "series"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = plan_of(returns.weekly_states(spark.read.parquet(os.path.join(tmp_dir, "series")), dates.d2, dates.d1))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert f"GreaterThan(TradingDay,{dates.d2})" in plan and f"LessThanOrEqual(TradingDay,{dates.d1})" in plan
    plan = plan_of(returns.volatility_from_states(spark, path, dates))
    assert "PartitionFilters: [isnotnull(quarter" in plan


def test_many_quarters_of_sums_and_deviations(spark):
    runs = [rating_dates(d) for d in catalog.HISTORY]
    series = standins.unitnvrestored(spark, SF)
    nav = standins.mainfinancialindex(spark, SF)
    v, n = returns.volatility_history(series, runs), sizing.nav_history(nav, runs, key="InnerCode")
    for r in runs:
        assert rows_of(v.filter(F.col("D1") == F.lit(r.d1)).drop("D1")) == rows_of(returns.volatility_quarters(series, r))
        assert rows_of(n.filter(F.col("D1") == F.lit(r.d1)).drop("D1")) == rows_of(sizing.nav_by_quarter(nav, r, key="InnerCode"))


def test_type_paths_of_any_depth(spark):
    rows = [(1, "a", 0, 1), (2, "b", 1, 1), (3, "c", 2, 1), (4, "d", 3, 1), (5, "e", 4, 1), (6, "f", None, 1),
            (7, "g", 8, 1), (8, "h", 9, 1), (9, "i", 7, 1), (10, "j", 7, 1),      # a cycle, and a node that leads into it
            (11, "k", 12, 1), (12, "l", 1, 0), (13, "m", 99, 1), (14, "n", 14, 1), (15, None, 1, 1)]
    df = spark.createDataFrame(rows, "FundTypeCode int, FundTypeName string, FNodeCode int, IfExecuted int")
    got = {x.code: ("".join(n.name or "?" for n in x.path), x.complete) for x in hierarchy.type_paths(df).collect()}
    assert got == {1: ("a", True), 2: ("ba", True), 3: ("cba", True), 4: ("dcba", True), 5: ("edcba", True), 6: ("f", True),
                   7: ("ghi", False), 8: ("hig", False), 9: ("igh", False), 10: ("jghi", False), 11: ("k", False), 13: ("m", False),
                   14: ("n", False), 15: ("?a", True)}
    assert hierarchy.type_paths(df.limit(0)).count() == 0
    levels = df.withColumn("Level", F.when(F.col("FundTypeCode") <= 5, F.col("FundTypeCode")).otherwise(1))
    flat = hierarchy.flatten_paths(levels, 5).collect()
    assert [tuple(x) for x in flat] == [(1, "a", 2, "b", 3, "c", 4, "d", 5, "e")]
