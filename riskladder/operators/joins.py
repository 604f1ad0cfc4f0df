"""Join operators of the rating jobs that carry more than an equality."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(table: DataFrame, keys: list[str], order: list[str], watch: Callable[..., DataFrame] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order`` (nulls last), so a lookup cannot multiply rows.
    An aggregate with partial sums, not a window; columns are keys and order. ``watch`` (a frame and named counters
    give the frame back, see ``sources.readers.RowCounts``) counts "keys" with several rows and the "rows" left out."""
    first = F.struct(*[F.struct(F.col(c).isNull(), F.col(c)).alias(c) for c in order])
    out = table.groupBy(*keys).agg(F.min(first).alias("_first"), F.count("*").alias("_rows"))
    if watch:
        out = watch(out, keys=F.count(F.when(F.col("_rows") > 1, 1)), rows=F.sum(F.col("_rows") - 1))
    return out.select(*keys, *[F.col("_first")[c][c].alias(c) for c in order])


def repeated_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows (for reports)."""
    return table.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def predecessors(df: DataFrame, after: dt.date | Column, watch: Callable[..., DataFrame] | None = None, by: list[str] = []) -> DataFrame:
    """Pre-conversion incarnations: main classes whose code ends in J, expiring after ``after``;
    of several with one code and expiry the smallest by code and type name. ``by`` names columns of
    separate runs held in one frame."""
    found = (df.filter(F.col("MainCode").endswith("J") & (F.col("ExpireDate") > F.lit(after))
                      & (F.col("MainCode") == F.col("SecurityCode")))
              .select(*by, F.col("FundTypeName3").alias("PreviousFundTypeName3"),
                      F.col("MainCode").alias("MainCodeJ"),
                      F.col("ExpireDate").alias("ExpireDateJ"))
              .withColumn("MainCodeJoin", F.substring("MainCodeJ", 1, 6)))
    return one_per_key(found, [*by, "MainCodeJoin", "ExpireDateJ"], ["MainCodeJ", "PreviousFundTypeName3"], watch)


def attach_predecessor(df: DataFrame, pred: DataFrame, by: list[str] = []) -> DataFrame:
    """Left join on (code, establish date = predecessor's expire date); the left-only
    condition ``EstablishmentDateII is not null`` sits in ON, so unmatched rows stay."""
    cond = ((df["MainCode"] == pred["MainCodeJoin"])
            & (df["EstablishmentDate"] == pred["ExpireDateJ"])
            & df["EstablishmentDateII"].isNotNull())
    pred = pred.withColumnsRenamed({c: f"_{c}" for c in by})
    for c in by:
        cond = cond & (df[c] == pred[f"_{c}"])
    return df.join(pred, cond, "left").drop(*[f"_{c}" for c in by])


def left_lookup(df: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left equi-join USING ``keys``. No broadcast hint: the planner broadcasts the
    table when its known size is under the threshold and shuffles otherwise
    (fixed tables are local relations of exact size, see ``sources.local``)."""
    return df.join(table, keys, "left")
