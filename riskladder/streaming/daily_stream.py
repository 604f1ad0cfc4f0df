"""Daily pre-rating driven by newly arriving fund archive files.

The batch daily job re-rates every share class missing from the newest
published batch. Run as a stream, each archive file that lands in
``archive_dir`` is read exactly once (the file log lives in the stream's
checkpoint folder), and each micro-batch rates just the share classes it
brings, with the same operators as the batch job:

    readStream(archives) -> foreachBatch:
        master(batch archives, dimensions) -> anti-join newest batch -> rules
        -> write partition batch=<id>/EndDate=<day> (overwrite: a replayed batch is idempotent)

Dimensions (security master, type history, type tree, official ratings, the
published batches) are re-read per micro-batch, so their latest files are used.
The rating date is an argument (the scheduler passes the run date); with
``available_now`` the query processes what has arrived and stops.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskladder.functions import lookups as L
from riskladder.functions.calendar import rating_dates
from riskladder.plans.daily import base_rating_daily
from riskladder.plans.master import build_master
from riskladder.session import materialize
from riskladder.sources import schemas, sinks


def start_daily_stream(spark: SparkSession, archive_dir: str, dimensions: Callable[[], dict[str, DataFrame]],
                       output: str, checkpoint: str, as_of: dt.date, fmt: str = "parquet",
                       available_now: bool = True, cut_type_history: bool = True,
                       out_format: str = "parquet", check: Callable[[], None] | None = None) -> StreamingQuery:
    """Start the stream. ``dimensions()`` returns secumain, fundtype, fundrisklevel,
    fundtypechangenew, last_batch, fundtyperisklevel and, to replace the built-in basic
    levels, mapping DataFrames (called once per micro-batch). ``check`` may raise when a micro-batch has been rated
    and before its partition is written."""
    archives = spark.readStream.schema(schemas.FUNDARCHIVES).format(fmt).load(archive_dir)
    d1 = rating_dates(as_of).d1

    def rate(batch: DataFrame, batch_id: int) -> None:
        t = dimensions()
        master = build_master(t["secumain"], batch, t["fundtype"], t["fundrisklevel"],
                              t["fundtypechangenew"], d1, as_of if cut_type_history else None)
        # only share classes that arrived in this batch (the master joins secumain first)
        master = master.join(batch.select("InnerCode"), "InnerCode", "left_semi")
        mapping = t["mapping"] if "mapping" in t else L.risk_mapping(spark, "InitialRiskLevel")
        rated = base_rating_daily(master, mapping, t["fundtyperisklevel"], t["last_batch"], as_of)
        if check:
            rated = materialize(rated)
            check()
        # a replayed batch id overwrites only its own partition: idempotent, no duplicates
        sinks.write_rating(rated.withColumn("batch", F.lit(batch_id)), output, out_format, partition_by=["batch", "EndDate"])

    writer = archives.writeStream.foreachBatch(rate).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
