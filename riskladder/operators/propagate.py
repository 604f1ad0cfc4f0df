"""Copy the main share class's values to every share class of the same fund.

Written as ``min_by`` aggregate + join back instead of a window: the aggregate
combines map-side, so a fund code holding a third of all rows (e.g. the null
code) reaches the reducer as one row per map task, and the join back can be
split by AQE's skew handling. Nulls on the main row are copied as nulls (the
first row wins, nulls are not skipped); rows are ordered by the given order
columns, which must make the order total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def propagate_first(df: DataFrame, group: str, order: list[str], cols: list[str]) -> DataFrame:
    """Replace ``cols`` on every row by the values of the first row of its ``group`` by ``order``."""
    first = (df.groupBy(group)
               .agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_first"))
               .withColumnRenamed(group, "_grp"))
    joined = df.drop(*cols).join(first, df[group].eqNullSafe(first["_grp"]), "left")
    return joined.select(*[F.col(f"_first.{c}").alias(c) if c in cols else F.col(c) for c in df.columns])
