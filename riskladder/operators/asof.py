"""As-of operators over effective-dated history.

``latest_per_key`` is top-1 per key written as an aggregate, ``max(struct(order
columns..., payload...))``: partial aggregation runs before the shuffle, so a key
holding a third of all rows leaves each map task as one row. The payload
columns follow the order columns inside the struct, which makes ties
deterministic. (A struct buffer plans as a sort-based aggregate; each map task
sorts only its own rows.)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | list[str], order: list[str],
                   payload: list[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (nulls lowest).

    Equal ``order`` values are broken by the payload columns, descending.
    Returns key column(s) + ``order`` + ``payload`` columns.
    """
    keys = [key] if isinstance(key, str) else list(key)
    fields = list(dict.fromkeys(order + payload))
    best = F.max(F.struct(*[F.col(c) for c in fields])).alias("_best")
    return (df.groupBy(*keys).agg(best)
              .select(*keys, *[F.col("_best")[c].alias(c) for c in fields]))


def latest_at_dates(df: DataFrame, key: str, day: str, dates: list[dt.date], order: list[str], payload: list[str],
                    name: str = "as_of") -> DataFrame:
    """Many as-of dates in one pass: for every date of ``dates`` the rows that
    ``latest_per_key(effective_at(df, day, date), key, order, payload)`` gives, with the date in column ``name``.

    A row counts from the first listed date on or after its ``day``; per key and such slot only the greatest
    row is kept (an aggregate with partial sums), so a key holding a third of all rows leaves the
    scan as one row per slot. What is in force in a slot is the greatest row up to it, valid until the slot
    where the key has its next row (``lead``); each interval is unfolded into the dates it covers,
    so no range join and no cross join is planned. ``dates`` is a parameter list."""
    days = sorted(set(dates))
    if not days:
        return df.select(key, F.lit(None).cast("date").alias(name), *dict.fromkeys(order + payload)).limit(0)
    fields = list(dict.fromkeys(order + payload))
    slot = sum((F.when(F.col(day) > F.lit(x), 1).otherwise(0) for x in days), F.lit(0))
    rows = df.filter(F.col(day) <= F.lit(days[-1])).select(F.col(key), slot.alias("_slot"), F.struct(*fields).alias("_row"))
    top = rows.groupBy(key, "_slot").agg(F.max("_row").alias("_row"))
    by_slot = Window.partitionBy(key).orderBy("_slot")
    held = top.select(key, "_slot", F.max("_row").over(by_slot.rowsBetween(Window.unboundedPreceding, 0)).alias("_row"),
                      (F.coalesce(F.lead("_slot").over(by_slot), F.lit(len(days))) - 1).alias("_until"))
    at = F.element_at(F.array(*[F.lit(x) for x in days]), F.col("_at") + 1)
    return (held.withColumn("_at", F.explode(F.sequence("_slot", "_until")))
            .select(key, at.alias(name), *[F.col("_row")[c].alias(c) for c in fields]))


def effective_at(df: DataFrame, start_col: str, as_of: dt.date | Column) -> DataFrame:
    """Rows whose effective date is on or before ``as_of``."""
    ref = F.lit(as_of) if isinstance(as_of, dt.date) else as_of
    return df.filter(F.col(start_col) <= ref)


def alive_at(start: Column | str, end: Column | str, as_of: dt.date | Column) -> Column:
    """Started on/before ``as_of`` and not ended by it; a null end means still open."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    d = F.lit(as_of)
    return (s <= d) & ((e > d) | e.isNull())


def latest_batch(df: DataFrame, date_col: str, number_col: str) -> DataFrame:
    """Rows of the newest batch: greatest date, then greatest number within that date.

    One scalar sub-query over ``max(struct(date, number))`` - partial aggregation,
    no driver round trip, no join.
    """
    newest = df.select(F.max(F.struct(F.col(date_col).alias("d"), F.col(number_col).alias("n")))).scalar()
    return df.filter((F.col(date_col) == newest["d"]) & (F.col(number_col) == newest["n"]))
