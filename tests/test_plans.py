"""Plan-shape guards: properties of the physical plans the design relies on."""

import datetime as dt
import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from riskladder.functions.calendar import rating_dates
from riskladder.operators import propagate, returns
from riskladder.sources import standins as S

SF = "/root/testdata/sf0.001"


def _final_plan(df):
    df.collect()                                      # finalises the adaptive plan in place
    return df._jdf.queryExecution().executedPlan().toString()


def test_volatility_reads_series_once_with_two_shuffles(spark):
    df = returns.volatility_quarters(S.unitnvrestored(spark, SF), rating_dates(dt.date(2001, 2, 15)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1] if "== Initial Plan ==" in plan else plan
    assert initial.count("FileScan parquet") == 1
    assert len(re.findall(r"Exchange hashpartitioning", initial)) == 2
    assert "Join" not in initial and "Window" not in initial


def test_propagation_is_an_aggregate_not_a_window(spark):
    df = spark.range(100).select((F.col("id") % 7).cast("string").alias("g"), F.col("id").alias("o"),
                                 (F.col("id") * 2).alias("v"))
    plan = propagate.propagate_first(df, "g", ["o"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "min_by" in plan


def test_rating_plans_have_no_cartesian_or_python(spark):
    for name in ("rating_quarterly", "rating_daily", "sd_flag"):
        plan = _final_plan(E.queries()[name](spark, SF))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)


def test_master_is_not_shuffled_by_type_code(spark):
    for name in ("master", "rating_daily", "rating_base"):
        df = E.queries()[name](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange hashpartitioning\((FundTypeCode3|FundTypeCode#|FundType#)", plan), name


def test_index_series_scans_lineitem_once(spark):
    for name, most in (("benchmark_row", 1), ("union_series", 1), ("sd_flag", 2), ("sd_factor", 2)):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("FileScan parquet") <= most, name
