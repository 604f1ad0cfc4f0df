import os

from pyspark.sql import functions as F

from riskladder.plans import catalog
from riskladder.sources import schemas, standins
from riskladder.streaming import start_daily_stream

SF = "/root/testdata/sf0.001"


def test_daily_stream_rates_each_arriving_file_once(spark, tmp_dir):
    t = standins.fund_tables(spark, SF)
    arch = t["fundarchives"].select(*schemas.FUNDARCHIVES.fieldNames())
    drops, out, ckpt = (os.path.join(tmp_dir, x) for x in ("archives", "out", "ckpt"))
    arch.filter(F.col("InnerCode") < 5).write.parquet(os.path.join(drops, "d1"))

    def dims():
        return {k: t[k] for k in ("secumain", "fundtype", "fundrisklevel", "fundtypechangenew", "last_batch", "fundtyperisklevel")}

    q = start_daily_stream(spark, drops + "/*", dims, out, ckpt, catalog.AS_OF)
    q.awaitTermination(300)
    first = spark.read.parquet(out).count()
    arch.filter(F.col("InnerCode") >= 5).write.parquet(os.path.join(drops, "d2"))
    q = start_daily_stream(spark, drops + "/*", dims, out, ckpt, catalog.AS_OF)
    q.awaitTermination(300)
    table = spark.read.parquet(out)
    assert table.select("batch").distinct().count() == 2
    got = sorted(r.InnerCode for r in table.collect())
    want = sorted(r.InnerCode for r in catalog.QUERIES["rating_daily"](spark, SF).collect())
    assert got == want and len(got) > first >= 0


def test_stream_command_line(spark, tmp_dir):
    import shutil
    from riskladder.__main__ import main
    from tests_helpers_extracts import write_extracts
    ex, drops, out, ckpt = (os.path.join(tmp_dir, x) for x in ("extracts", "archives", "out", "ckpt"))
    write_extracts(spark, ex, ["secumain", "fundtype", "fundrisklevel", "fundtypechangenew", "last_batch", "fundtyperisklevel"])
    t = standins.fund_tables(spark, SF)
    t["fundarchives"].select(*schemas.FUNDARCHIVES.fieldNames()).write.parquet(os.path.join(drops, "d1"))
    main(["stream", "--extracts", ex, "--archives", drops + "/*", "--checkpoint", ckpt,
          "--as-of", "2001-02-15", "--out", out])
    got = sorted(r.InnerCode for r in spark.read.parquet(out).collect())
    want = sorted(r.InnerCode for r in catalog.QUERIES["rating_daily"](spark, SF).collect())
    assert got == want
