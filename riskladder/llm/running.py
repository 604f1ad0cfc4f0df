"""Running sums over a global order without putting the order, or a hot group, in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskladder.llm.arrays import reduce_tasks
from riskladder.session import materialize


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, str], group: str | None = None) -> DataFrame:
    """Adds, for each ``new: value`` of ``sums``, the sum of ``value`` over the rows before this
    one in ``order`` (within ``group`` if given; ``order`` must then begin with the group).

    Rows are dealt out by range, so a group of any size is spread; each range is summed, the
    few range totals (at most one per range and group) give every range its start, and
    a window runs inside the ranges only.
    """
    n = reduce_tasks(df)
    placed = materialize(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))
    by = [group] if group else []
    totals = placed.groupBy("_range", *by).agg(*[F.sum(v).alias(k) for k, v in sums.items()])
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumns({k: F.coalesce(F.sum(k).over(before), F.lit(0)) for k in sums})
    starts = totals.select(F.col("_range").alias("_r"), *[F.col(g).alias("_g") for g in by],
                           *[F.col(k).alias(f"_{k}") for k in sums])
    on = F.col("_range") == F.col("_r")
    if group:
        on = on & F.col(group).eqNullSafe(F.col("_g"))
    inside = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumns({k: F.coalesce(F.sum(v).over(inside), F.lit(0)) for k, v in sums.items()})
    out = out.join(starts, on).withColumns({k: F.col(k) + F.col(f"_{k}") for k in sums})
    return out.drop("_range", "_r", "_g", *[f"_{k}" for k in sums])
