"""Readers for the rating extracts (CSV or Parquet) with explicit schemas.

* every read gets a schema: nothing is inferred, nothing arrives as strings;
* every file of a header extract is bound by its own header: order and extra columns do not matter and
  may differ from file to file; a file without a declared column fails by name;
* malformed values become null; ``corrupt_rows`` selects their rows, ``RowCounts`` counts them (and rows
  without a key) while the job itself reads the extract, without a scan of its own;
* legacy Chinese encodings (cp936/GBK) need ``spark.sql.legacy.javaCharsets`` in Spark 4, a
  setting of the whole session that is left to the caller; a read without it fails clearly.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from threading import Thread

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskladder.sources import schemas

CORRUPT = "_corrupt_record"
_LEGACY_CHARSETS = {"cp936", "gbk", "gb2312", "gb18030"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool,
             encoding: str | None = None, keep_corrupt: bool = False) -> DataFrame:
    """CSV with an explicit schema; ``keep_corrupt`` adds the raw text of unparsable rows."""
    if encoding and encoding.lower() in _LEGACY_CHARSETS and spark.conf.get("spark.sql.legacy.javaCharsets", "false") != "true":
        raise ValueError(f"reading {encoding} needs spark.sql.legacy.javaCharsets=true in the session")
    reader = lambda: spark.read.option("encoding", encoding) if encoding else spark.read
    if header:
        parts = [_by_name(reader().option("header", True).option("enforceSchema", False).schema(_strings(names)).csv(files), schema, keep_corrupt)
                 for names, files in header_groups(reader, path, schema)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    read_schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)]) if keep_corrupt else schema
    df = (reader().schema(read_schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return df if keep_corrupt else df.select(*schema.fieldNames())


def _strings(names: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def header_groups(reader, path: str, schema: T.StructType) -> list[tuple[tuple[str, ...], list[str] | str]]:
    """(header, files that have it) for every header of an extract, in order of appearance.

    Spark binds all files of one read by the first file's header, so files are grouped by their header
    and each group is read with its own; Spark then checks every file against it again when it is read
    (``enforceSchema`` off). A header takes a one-line read per file, a few at a time; the driver holds
    only names. Two columns of one name make the read fail. One header (the usual case) reads the path as given. Empty files have no header and
    no rows; a path with nothing else gives an empty extract."""
    files = reader().text(path).inputFiles()
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: tuple(reader().option("header", True).csv(f).columns), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for f, names in zip(files, headers):
        if names:
            missing = [n for n in schema.fieldNames() if n not in names]
            if missing:
                raise ValueError(f"{f}: the header has no column {', '.join(missing)}")
            groups.setdefault(names, []).append(f)
    if not groups:
        return [(tuple(schema.fieldNames()), path)]
    return [(names, path if len(groups) == 1 else of) for names, of in groups.items()]


def _by_name(raw: DataFrame, schema: T.StructType, keep_corrupt: bool) -> DataFrame:
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields}
    cols = [c.alias(n) for n, c in typed.items()]
    if keep_corrupt:
        bad = F.array_contains(F.array(*[F.col(n).isNotNull() & c.isNull() for n, c in typed.items()]), True)
        cols.append(F.when(bad, F.to_json(F.struct(*[F.col(n) for n in schema.fieldNames()]))).alias(CORRUPT))
    return raw.select(*cols)


def read_extract(spark: SparkSession, name: str, path: str, fmt: str = "csv",
                 encoding: str | None = None) -> DataFrame:
    """Read one named extract (see ``schemas.EXTRACTS``) and prune to its columns."""
    schema, header = schemas.EXTRACTS[name]
    if fmt == "csv":
        return read_csv(spark, path, schema, header, encoding)
    return spark.read.schema(schema).format(fmt).load(path).select(*schema.fieldNames())


def corrupt_rows(df: DataFrame) -> DataFrame:
    """Rows the CSV parser could not convert (df must come from keep_corrupt=True).

    All columns are kept: Spark refuses a CSV query that reads nothing but the
    corrupt-record column, so count these rows through a query over the row."""
    return df.filter(F.col(CORRUPT).isNotNull())


def validate(df: DataFrame, name: str) -> DataFrame:
    """Drop rows whose required columns are null (they could never join)."""
    cols = schemas.REQUIRED.get(name, [])
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df if cond is None else df.filter(cond)


class RowCounts:
    """Row counts gathered by the actions that read the rows anyway (``DataFrame.observe``).

    ``watch`` adds counters to a frame; ``get`` gives their values once an action has run through it.
    A counter is taken from the first such action. A frame that no action needed (the
    planner can leave an input out, such as one side of a join with nothing) has no counts: None.
    A watched frame is a barrier for filters and columns: nothing is pushed below it."""

    def __init__(self):
        self._watched: dict[str, Observation] = {}
        self._done: dict[str, dict[str, int] | None] = {}

    def watch(self, name: str, df: DataFrame, **counts: Column) -> DataFrame:
        self._watched[name] = o = Observation(f"{name}-{id(self)}")
        return df.observe(o, *[c.alias(k) for k, c in counts.items()])

    def get(self, name: str, wait: float = 5.0) -> dict[str, int] | None:
        if name not in self._done:
            got: list[dict] = []

            def ask() -> None:
                try:
                    got.append(self._watched[name].get)
                except Exception:                  # the action failed: there is no count
                    pass

            t = Thread(target=ask, daemon=True)
            t.start()
            t.join(wait)                           # the value is there when the action has returned
            if not got:
                return None
            self._done[name] = {k: v or 0 for k, v in got[0].items()}
        return self._done[name]

    def all(self) -> dict[str, dict[str, int] | None]:
        return {name: self.get(name) for name in self._watched}


def read_counted(spark: SparkSession, name: str, path: str, fmt: str, encoding: str | None, counts: RowCounts) -> DataFrame:
    """An extract as ``validate(read_extract(...))`` gives it, watched for "malformed" (rows with a value that does
    not parse) and "dropped" (rows without a required key). The hash makes the parser read every
    column, whatever the job needs, so that the counts do not depend on the job."""
    schema, header = schemas.EXTRACTS[name]
    keys = [F.col(c).isNull() for c in schemas.REQUIRED.get(name, [])]
    dropped = F.count(F.when(F.array_contains(F.array(*keys), True) if keys else F.lit(False), 1))
    if fmt == "csv":
        df = read_csv(spark, path, schema, header, encoding, keep_corrupt=True)
        malformed = F.count(F.when(F.col(CORRUPT).isNotNull() & (F.xxhash64(*schema.fieldNames()) != 0), 1))
    else:
        df, malformed = read_extract(spark, name, path, fmt), F.count(F.when(F.lit(False), 1))
    return validate(counts.watch(name, df, malformed=malformed, dropped=dropped).select(*schema.fieldNames()), name)
