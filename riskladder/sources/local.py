"""Small fixed tables (configuration, code lists) as Spark local relations.

``spark.createDataFrame(list)`` plans as an RDD scan of unknown size, so the
planner can never broadcast it on its own. A SQL ``VALUES`` relation is a local
relation whose exact byte size the planner knows: joins against it are
broadcast by the planner's size check, and would fall back to a shuffle join if
such a table ever outgrew the broadcast threshold.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, dt.date):
        return f"DATE'{v.isoformat()}'"
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Rows + ``"name type, name type"`` -> DataFrame backed by a local relation."""
    fields = [f.strip().split(None, 1) for f in ddl.split(",")]
    names = [n for n, _ in fields]
    body = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in fields)
    return spark.sql(f"SELECT {cols} FROM VALUES {body} AS t({', '.join(f'`{n}`' for n in names)})")
