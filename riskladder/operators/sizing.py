"""Net-asset size per quarter.

The quarter pivot is one conditional sum per label over explicit labels: one
shuffle, partial aggregation, and all four columns exist even when a quarter has
no rows at all (a data-driven pivot would drop the column).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskladder.functions.calendar import QUARTER_LABELS, RatingDates, in_window


def quarter_label(day: Column, dates: RatingDates) -> Column:
    """Quarter of a day inside (D5, D1]: Last (D2, D1], Second, Third, else Forth."""
    return (F.when(day > F.lit(dates.d2), "Last")
             .when(day > F.lit(dates.d3), "Second")
             .when(day > F.lit(dates.d4), "Third")
             .otherwise("Forth"))


def _year_rows(nav: DataFrame, dates: RatingDates, day: str, value: str) -> DataFrame:
    return (nav.filter(in_window(F.col(day), dates.d5, dates.d1))
               .withColumns({"Qrt": F.concat(quarter_label(F.col(day), dates), F.lit("QrtNV")),
                             "_v": F.col(value)}))


def _scaled_sum(values: Column) -> Column:
    """sum(value) / 10000 as decimal(38,9): equal to summing value / 10000 exactly
    (scale 3 -> 7), but divides once per group instead of once per row."""
    return (F.sum(values) / 10000).cast("decimal(38,9)")


def nav_sum(nav: DataFrame, dates: RatingDates, key: str = "MainCode",
            day: str = "EndDate", value: str = "NetAssetsValue") -> DataFrame:
    """-> key, Qrt, NetAssetsValueSum (value / 10000 summed per key and quarter)."""
    return (_year_rows(nav, dates, day, value)
            .groupBy(key, "Qrt").agg(_scaled_sum(F.col("_v")).alias("NetAssetsValueSum")))


def nav_by_quarter(nav: DataFrame, dates: RatingDates, key: str = "MainCode",
                   day: str = "EndDate", value: str = "NetAssetsValue") -> DataFrame:
    """-> key, LastQrtNV, SecondQrtNV, ThirdQrtNV, ForthQrtNV as decimal(38,9)."""
    rows = _year_rows(nav, dates, day, value)
    aggs = [_scaled_sum(F.when(F.col("Qrt") == f"{lab}QrtNV", F.col("_v"))).alias(f"{lab}QrtNV")
            for lab in QUARTER_LABELS]
    return rows.groupBy(key).agg(*aggs)


def nav_history(nav: DataFrame, runs: list[RatingDates], key: str = "MainCode",
                day: str = "EndDate", value: str = "NetAssetsValue") -> DataFrame:
    """``nav_by_quarter`` of every run in one pass -> key, D1 and the four sums. Values are summed once per
    quarter; each sum then serves the (at most four) runs that look back on its quarter."""
    quarter = F.last_day(F.add_months(F.trunc(F.col(day), "quarter"), 2))
    rows = nav.filter(in_window(F.col(day), min(r.d5 for r in runs), max(r.d1 for r in runs)))
    sums = rows.groupBy(key, quarter.alias("_q")).agg(_scaled_sum(F.col(value)).alias("_v"))
    uses = F.array(*[F.struct(F.lit(r.d1).alias("D1"), F.lit(end).alias("end"), F.lit(label).alias("label"))
                     for r in runs for label, end in zip(QUARTER_LABELS, r.quarter_ends)])
    used = sums.select(key, "_v", F.explode(F.filter(uses, lambda u: u["end"] == F.col("_q"))).alias("_u"))
    return used.groupBy(key, F.col("_u.D1").alias("D1")).agg(
        *[F.max(F.when(F.col("_u.label") == label, F.col("_v"))).alias(f"{label}QrtNV") for label in QUARTER_LABELS])
