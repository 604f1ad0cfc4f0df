"""Result sinks and the carried-over state of the previous quarter.

The rating table is partitioned by ``EndDate``. ``replace_date`` replaces the partition of one rated
date: everything is computed before the table is touched, so a job that fails leaves the old
partition, and a run without rows leaves an empty one. Reading last quarter's state prunes to one
partition. No ``repartition(1)``: every task writes its own files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskladder.session import materialize


def write_rating(df: DataFrame, path: str, fmt: str = "parquet",
                 partition_by: str | list[str] | None = "EndDate") -> None:
    """Write the rating table; only the partitions present in ``df`` are replaced."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def replace_dates(df: DataFrame, path: str, dates: list[dt.date], fmt: str = "parquet", check: Callable[[], None] | None = None,
                  column: str = "EndDate") -> DataFrame:
    """Replace the partitions ``column = date`` of the table, for every date of ``dates``, by the rows of ``df``; rows of
    other dates are left out.

    ``df`` is checkpointed first: whatever can fail while it is computed, and ``check``, which may raise
    after that, comes before the table changes. The checkpoint is then written by Spark's dynamic
    partition overwrite, which puts the files beside the table and moves them in place when all are
    there; between dropping an old folder and moving the new one the storage decides what a
    reader sees. A date without rows is overwritten by an empty partition. Returns the rows as written."""
    staged = materialize(df.filter(F.col(column).isin(dates)))
    if check:
        check()
    there = {r[0] for r in staged.select(column).distinct().collect()}          # at most the dates given
    for date in dates:
        if date not in there:
            writer = staged.sparkSession.createDataFrame([], staged.drop(column).schema).write.mode("overwrite")
            (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(f"{path.rstrip('/')}/{column}={date.isoformat()}")
    if there:
        write_rating(staged, path, fmt, column)
    return staged


def replace_date(df: DataFrame, path: str, date: dt.date, fmt: str = "parquet", check: Callable[[], None] | None = None,
                 column: str = "EndDate") -> DataFrame:
    """``replace_dates`` for one date, which all rows of ``df`` get."""
    return replace_dates(df.drop(column).withColumn(column, F.lit(date)), path, [date], fmt, check, column)


def read_previous_state(spark: SparkSession, path: str, previous_end: dt.date,
                        fmt: str = "parquet") -> DataFrame:
    """FundSizeStatus / SDStatus carried from the run whose EndDate is ``previous_end``
    (a partition filter: only that quarter's files are read)."""
    table = (spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path))
    return (table.filter(F.col("EndDate") == F.lit(previous_end))
                 .select(F.col("InnerCode").cast("int"), F.col("FundSizeStatus").cast("int"),
                         F.col("SDStatus").cast("int"), F.col("HigherRiskLevel").cast("string"),
                         F.col("HigherRiskLevelName").cast("string")))
