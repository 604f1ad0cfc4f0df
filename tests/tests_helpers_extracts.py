"""Write stand-in tables as CSV extracts (shared by job and streaming tests)."""

import os

from pyspark.sql import functions as F

from riskladder.sources import schemas, standins

SF = "/root/testdata/sf0.001"


def write_extracts(spark, folder, names, sf=SF):
    tables = standins.fund_tables(spark, sf)
    for name in names:
        schema, header = schemas.EXTRACTS[name]
        df = tables[name].select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        df.write.mode("overwrite").option("header", header).csv(os.path.join(folder, f"{name}.csv"))
