"""Spark-vs-DuckDB comparison used by the tests and by hand.

    python tests/oracle_compare.py [sf_dir] [key ...]

Compares row count, column names (sorted) and an order-insensitive multiset of
normalised row values (floats to 12 significant digits, decimals exact).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


STRICT = os.environ.get("ORACLE_STRICT") == "1"   # exact float equality


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return v.normalize() if v != 0 else decimal.Decimal(0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "tinyint": "TINYINT",
         "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN"}


def spark_type_as_duck(simple: str) -> str:
    if simple.startswith("decimal"):
        return simple.upper().replace(" ", "")
    return _DUCK.get(simple, simple.upper())


def compare(spark, con, name, sf_dir, queries, sqls):
    sdf = queries[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sqls[name])
    d_cols = rel.columns
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark-only={sorted(set(s_cols) - set(d_cols))} "
                        f"sql-only={sorted(set(d_cols) - set(s_cols))}")
    else:
        d_types = {c: str(t).replace(" ", "") for c, t in zip(d_cols, rel.types)}
        wrong = [(c, t, d_types[c]) for c, t in sdf.dtypes if spark_type_as_duck(t) != d_types[c]]
        if wrong:
            problems.append(f"types differ (column, spark, sql): {wrong}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} sql={len(d_rows)}")
    if not problems:
        a, b = rows_of(s_rows, s_cols), rows_of(d_rows, d_cols)
        if a != b:
            only_s, only_d = a - b, b - a
            problems.append(f"values differ: {sum(only_s.values())} rows; e.g. spark={list(only_s)[:2]} "
                            f"sql={list(only_d)[:2]} (cols {sorted(s_cols)})")
    return len(s_rows), problems


def main(argv):
    from riskladder.session import build_session
    from __spark_entry__ import oracle_sql, queries
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = ran = 0
    for name in qs:
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"--   {name}: no oracle")
            continue
        try:
            n, problems = compare(spark, con, name, sf_dir, qs, sqls)
        except Exception as e:  # report and continue
            n, problems = -1, [f"{type(e).__name__}: {str(e)[:400]}"]
        bad += bool(problems)
        ran += 1
        print(f"{'OK ' if not problems else 'BAD'}  {name} rows={n} {' | '.join(problems)}")
    print(f"{ran - bad}/{ran} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
