"""Weekly compounded returns and their rolling 3-year volatility.

One pass over the return series for all four quarter windows:

    series -> filter (D9, D1]
           -> groupBy(key, week): for each window i, product of in-window growth
              factors and the in-window row count        (partial agg before shuffle 1)
           -> groupBy(key): exact moments of each window's weekly returns (sample_sd) and
              the summed counts                            (partial agg before shuffle 2)
           -> keep keys with at least one row in every window

The second aggregate reads one row per (key, week), so even a key that holds a
third of all rows reaches it as a few hundred rows: the plan is skew-safe
without salting. No joins, no Python, input read once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskladder.functions.calendar import QUARTER_LABELS, RatingDates, in_window, week_number
from riskladder.sources.sinks import write_rating

WEEK = "weekNum"


def growth_factor(rate: Column | str) -> Column:
    """1 + rate/100 in double arithmetic.

    Decimal division here widens past 18 digits and runs on java BigDecimal per
    row (about 2x the cost of the whole expression at sf0.1); double arithmetic is
    within an ulp of the exact value, which ``compound``'s rounding at 1e-13 absorbs.
    """
    r = F.col(rate) if isinstance(rate, str) else rate
    return r.cast("double") / 100 + 1


def compound(factor: Column) -> Column:
    """Aggregate: product of growth factors minus 1 as decimal(18,6), half-up.

    The double product is first rounded at 1e-13 to strip binary noise, so a
    value whose exact decimal form ends in 5 at the 7th place rounds up the way
    exact decimal compounding would. No values -> null.
    """
    return (F.product(factor) - 1).try_cast("decimal(28,13)").try_cast("decimal(18,6)")


def sample_sd(r: Column | str) -> Column:
    """Aggregate: sample standard deviation of decimal(18,6) values, free of the order of the rows.

    Count, sum and sum of squares are exact decimals, so partial results merge to the same value whatever
    the partitioning; one division and one root in double arithmetic follow. Fewer than two values: null.
    The exact difference n * sum(r^2) - sum(r)^2 holds while |sum(r)| < 1e10 and sum(r^2) < 1e16; beyond, it is taken from
    the two sums as doubles, and is null when the sum of squares passes 1e26."""
    r = F.col(r) if isinstance(r, str) else r
    r = r.cast("decimal(18,6)")
    n, s1, s2 = F.count(r), F.sum(r), F.try_sum(r * r)
    narrow = s1.try_cast("decimal(16,6)")
    exact = n.try_cast("decimal(6,0)") * s2.try_cast("decimal(28,12)") - narrow * narrow
    rough = F.greatest(n.cast("double") * s2.cast("double") - s1.cast("double") * s1.cast("double"), F.lit(0.0))
    return F.when(n > 1, F.sqrt(F.coalesce(exact.cast("double"), rough) / (n * (n - 1)).cast("double")))


def weekly_returns(series: DataFrame, key: str, day: str, rate: str) -> DataFrame:
    """-> key, weekNum, weekly_return for every (key, week) of the series."""
    return (series.select(key, week_number(F.col(day)).alias(WEEK), growth_factor(rate).alias("_f"))
                  .groupBy(key, WEEK).agg(compound(F.col("_f")).alias("weekly_return")))


def volatility_window(series: DataFrame, lo: dt.date, hi: dt.date, out_col: str,
                      key: str = "InnerCode", day: str = "TradingDay",
                      rate: str = "NVRDailyGrowthRate") -> DataFrame:
    """Sample SD of weekly returns over the rows in (lo, hi] -> key, out_col."""
    window_rows = series.filter(in_window(F.col(day), lo, hi))
    return (weekly_returns(window_rows, key, day, rate)
            .groupBy(key).agg(sample_sd("weekly_return").alias(out_col)))


def volatility_windows(series: DataFrame, windows: list[tuple[str, dt.date, dt.date]], key: str = "InnerCode",
                       day: str = "TradingDay", rate: str = "NVRDailyGrowthRate") -> DataFrame:
    """-> key, sd_<label>, n_<label> for each (label, lo, hi]: sample SD of the weekly returns inside the window
    and the number of its rows. One pass over the series, whatever the number of windows."""
    d = F.col(day)
    rows = (series.filter(in_window(d, min(lo for _, lo, _ in windows), max(hi for _, _, hi in windows)) & F.col(key).isNotNull())
                  .select(key, d.alias("_day"), week_number(d).alias(WEEK), growth_factor(rate).alias("_f")))
    week_aggs, key_aggs = [], []
    for label, lo, hi in windows:
        inside = in_window(F.col("_day"), lo, hi)
        week_aggs += [compound(F.when(inside, F.col("_f"))).alias(f"_r{label}"), F.count(F.when(inside, F.lit(1))).alias(f"_n{label}")]
        key_aggs += [sample_sd(f"_r{label}").alias(f"sd_{label}"), F.sum(f"_n{label}").alias(f"n_{label}")]
    return rows.groupBy(key, WEEK).agg(*week_aggs).groupBy(key).agg(*key_aggs)


def _all_windows(labels: list[str]) -> Column:
    out = F.lit(True)
    for label in labels:
        out = out & (F.col(f"n_{label}") > 0)
    return out


def volatility_quarters(series: DataFrame, dates: RatingDates, key: str = "InnerCode",
                        day: str = "TradingDay", rate: str = "NVRDailyGrowthRate") -> DataFrame:
    """-> key, LastQrtSD, SecondQrtSD, ThirdQrtSD, ForthQrtSD for keys present in all four windows."""
    found = volatility_windows(series, dates.vol_windows, key, day, rate).filter(_all_windows(list(QUARTER_LABELS)))
    return found.select(key, *[F.col(f"sd_{label}").alias(f"{label}QrtSD") for label in QUARTER_LABELS])


def volatility_history(series: DataFrame, runs: list[RatingDates], key: str = "InnerCode",
                       day: str = "TradingDay", rate: str = "NVRDailyGrowthRate") -> DataFrame:
    """``volatility_quarters`` of every run in one pass -> key, D1 and the four deviations. Runs share
    windows (a quarter-end is the last quarter of one run, the second of the next)."""
    name = "{:%Y%m%d}".format
    windows = {name(hi): (name(hi), lo, hi) for r in runs for _, lo, hi in r.vol_windows}
    wide = volatility_windows(series, list(windows.values()), key, day, rate)
    rows = []
    for r in runs:
        labels = [name(hi) for _, _, hi in r.vol_windows]
        sds = [F.col(f"sd_{x}").alias(f"{label}QrtSD") for label, x in zip(QUARTER_LABELS, labels)]
        rows.append(F.when(_all_windows(labels), F.struct(F.lit(r.d1).alias("D1"), *sds)))
    return wide.select(key, F.explode(F.array_compact(F.array(*rows))).alias("_v")).select(key, "_v.*")


# --- stored weekly states ---------------------------------------------------

def weekly_states(series: DataFrame, lo: dt.date, hi: dt.date, key: str = "InnerCode",
                  day: str = "TradingDay", rate: str = "NVRDailyGrowthRate") -> DataFrame:
    """-> key, weekNum, quarter, factor, n for the rows in (lo, hi]: product of growth factors and number of rows of
    every (key, quarter, week). Windows begin and end with quarters, so a week that two quarters share is kept
    as one state in each, and states merge (products multiply, counts add) to exactly the week of a window."""
    d = F.col(day)
    quarter = F.last_day(F.add_months(F.trunc(d, "quarter"), 2)).alias("quarter")
    rows = series.filter(in_window(d, lo, hi) & F.col(key).isNotNull())
    return (rows.select(key, week_number(d).alias(WEEK), quarter, growth_factor(rate).alias("_f"))
            .groupBy(key, WEEK, "quarter").agg(F.product("_f").alias("factor"), F.count("*").alias("n")))


def store_states(series: DataFrame, path: str, lo: dt.date, hi: dt.date, **columns: str) -> None:
    """Add the quarters in (lo, hi] to the table of weekly states at ``path``, partitioned by quarter; a quarter that is
    there already is replaced (a late correction). Only the rows of these quarters are read."""
    write_rating(weekly_states(series, lo, hi, **columns), path, partition_by="quarter")


def volatility_from_states(spark: SparkSession, path: str, dates: RatingDates, key: str = "InnerCode") -> DataFrame:
    """``volatility_quarters`` from the stored states of the quarters in (D9, D1]: one state per key, quarter and
    week is read in place of the daily rows."""
    q = F.col("quarter").cast("date")
    held = spark.read.parquet(path).filter(in_window(q, dates.d9, dates.d1))
    week_aggs, key_aggs = [], []
    for label, lo, hi in dates.vol_windows:
        inside = in_window(q, lo, hi)
        week_aggs += [compound(F.when(inside, F.col("factor"))).alias(f"_r{label}"), F.coalesce(F.sum(F.when(inside, F.col("n"))), F.lit(0)).alias(f"_n{label}")]
        key_aggs += [sample_sd(f"_r{label}").alias(f"sd_{label}"), F.sum(f"_n{label}").alias(f"n_{label}")]
    found = held.groupBy(key, WEEK).agg(*week_aggs).groupBy(key).agg(*key_aggs).filter(_all_windows(list(QUARTER_LABELS)))
    return found.select(key, *[F.col(f"sd_{label}").alias(f"{label}QrtSD") for label in QUARTER_LABELS])
