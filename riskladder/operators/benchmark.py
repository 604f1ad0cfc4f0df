"""Benchmark indices and the volatility factors / standards derived from them.

The benchmark volatilities are one row. Instead of collecting them to the driver
and inlining literals, they stay in the plan as a scalar sub-query returning one
struct: executed once, broadcast as a value, no join and no driver round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskladder.functions.calendar import QUARTER_LABELS

# fixed values: inner codes of the two benchmark indices and the blend weights
INDEX_2968 = 2968
INDEX_14110 = 14110
WEIGHT_2968, WEIGHT_14110 = 0.8, 0.2
R2_MULTIPLE, R3_MULTIPLE, R4_MULTIPLE = 1.4, 1.4, 3


def bench_col(label: str, index: int) -> str:
    return f"{label}QrtSD_{index}"


def benchmark_aggregates(key: str = "InnerCode") -> list[Column]:
    return [F.max(F.when(F.col(key) == idx, F.col(f"{label}QrtSD"))).alias(bench_col(label, idx))
            for idx in (INDEX_2968, INDEX_14110) for label in QUARTER_LABELS]


def benchmark_row(index_vol: DataFrame, key: str = "InnerCode") -> DataFrame:
    """Volatility of both indices as one row: LastQrtSD_2968 ... ForthQrtSD_14110."""
    return index_vol.agg(*benchmark_aggregates(key))


def benchmark_scalar(index_vol: DataFrame, key: str = "InnerCode") -> Column:
    """The benchmark row as a struct-valued scalar sub-query."""
    row = benchmark_row(index_vol, key)
    return row.select(F.struct(*row.columns).alias("b")).scalar()


def with_benchmark(df: DataFrame, bench: Column, name: str = "_bench") -> DataFrame:
    """Evaluate the benchmark sub-query once, as one struct column of ``df``.

    Referencing fields of the sub-query expression directly would plant one
    sub-query per reference in the plan (they are not always deduplicated);
    one projected column keeps it to a single execution.
    """
    return df.withColumn(name, bench)


def factors_and_standards(level: Column, bench: Column) -> dict[str, Column]:
    """SD factor and SD standard per quarter for levels R2/R3/R4 (others 0).

    Division by a zero or missing benchmark gives null (try_divide).
    """
    out: dict[str, Column] = {}
    for label in QUARTER_LABELS:
        sd = F.col(f"{label}QrtSD")
        sd_2968 = bench[bench_col(label, INDEX_2968)]
        sd_14110 = bench[bench_col(label, INDEX_14110)]
        blend = F.lit(WEIGHT_2968) * sd_2968 + F.lit(WEIGHT_14110) * sd_14110
        out[f"{label}QrtSDFactor"] = (F.when(level == "R2", F.try_divide(sd, blend))
                                      .when(level == "R3", F.try_divide(sd, sd_14110))
                                      .when(level == "R4", F.try_divide(sd, sd_14110))
                                      .otherwise(0))
        out[f"{label}QrtStandard"] = (F.when(level == "R2", F.lit(R2_MULTIPLE) * blend)
                                      .when(level == "R3", F.lit(R3_MULTIPLE) * sd_14110)
                                      .when(level == "R4", F.lit(float(R4_MULTIPLE)) * sd_14110)
                                      .otherwise(0))
    return out
