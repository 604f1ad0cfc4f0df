import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from riskladder.sources import readers, schemas, sinks
from riskladder.sources.local import local_table


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_headerless_csv_with_schema_and_corrupt_rows(spark, tmp_dir):
    p = os.path.join(tmp_dir, "fundtypechangenew.csv")
    _write(p, "1,111010,2000-01-31\n2,bad,2000-02-29\n3,121010,not-a-date\n")
    df = readers.read_extract(spark, "fundtypechangenew", p)
    assert df.schema == schemas.FUNDTYPECHANGENEW
    assert sorted(tuple(r) for r in df.collect()) == [(1, 111010, dt.date(2000, 1, 31)), (2, None, dt.date(2000, 2, 29)),
                                                      (3, 121010, None)]
    raw = readers.read_csv(spark, p, schemas.FUNDTYPECHANGENEW, header=False, keep_corrupt=True)
    assert len(readers.corrupt_rows(raw).collect()) == 2


def test_header_files_bind_by_name(spark, tmp_dir):
    p = os.path.join(tmp_dir, "reordered.csv")
    _write(p, "Extra,SDStatus,InnerCode,FundSizeStatus,HigherRiskLevelName,HigherRiskLevel\nx,0,1,1,,R3\ny,bad,2,1,,\n")
    rows = {r.InnerCode: r for r in readers.read_extract(spark, "last_qrt", p).collect()}
    assert (rows[1].SDStatus, rows[1].FundSizeStatus, rows[1].HigherRiskLevel) == (0, 1, "R3") and rows[2].SDStatus is None
    counts = readers.RowCounts()
    assert readers.read_counted(spark, "last_qrt", p, "csv", None, counts).count() == 2
    assert counts.all() == {"last_qrt": {"malformed": 1, "dropped": 0}}
    narrow = os.path.join(tmp_dir, "narrow.csv")
    _write(narrow, "InnerCode,FundSizeStatus\n1,0\n")
    with pytest.raises(ValueError, match="SDStatus"):
        readers.read_extract(spark, "last_qrt", narrow)


def test_every_file_is_bound_by_its_own_header(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "mixed.csv")
    os.mkdir(folder)
    full = "HigherRiskLevel,HigherRiskLevelName"
    _write(f"{folder}/a.csv", f"InnerCode,FundSizeStatus,SDStatus,{full}\n1,0,1,R3,x\n2,1,0,,\n")
    _write(f"{folder}/b.csv", f"SDStatus,{full},Extra,InnerCode,FundSizeStatus\n0,R4,y,e,3,1\n")
    _write(f"{folder}/c.csv", f"SDStatus,{full},Extra,InnerCode,FundSizeStatus\n1,R5,z,e,4,0\n")
    _write(f"{folder}/d.csv", "")
    _write(f"{folder}/e.csv", f"InnerCode,{full},SDStatus,FundSizeStatus\n")
    got = sorted(tuple(r) for r in readers.read_extract(spark, "last_qrt", folder).collect())
    assert got == [(1, 0, 1, "R3", "x"), (2, 1, 0, None, None), (3, 1, 0, "R4", "y"), (4, 0, 1, "R5", "z")]
    _write(f"{folder}/f.csv", f"InnerCode,FundSizeStatus,{full}\n5,0,,\n")
    with pytest.raises(ValueError, match="f.csv.*SDStatus"):
        readers.read_extract(spark, "last_qrt", folder)
    void = os.path.join(tmp_dir, "void.csv")
    os.mkdir(void)
    _write(f"{void}/a.csv", "")
    df = readers.read_extract(spark, "last_qrt", void)
    assert df.schema == schemas.LAST_QRT_QUARTERLY and df.count() == 0


def test_counts_come_from_the_actions_of_the_job(spark, tmp_dir):
    p = os.path.join(tmp_dir, "secumain.csv")
    _write(p, "1,a,a,8,1\n2,b,b,eight,1\nx,c,c,8,1\n,d,d,8,1\n")
    counts = readers.RowCounts()
    df = readers.read_counted(spark, "secumain", p, "csv", None, counts)
    assert counts.get("secumain", wait=0.1) is None          # nothing has run yet
    assert df.filter("SecuCategory = 8").select("InnerCode").count() == 1
    assert counts.all() == {"secumain": {"malformed": 2, "dropped": 2}}
    from riskladder.session import materialize
    counts = readers.RowCounts()
    assert materialize(readers.read_counted(spark, "secumain", p, "csv", None, counts)).count() == 2
    assert counts.all() == {"secumain": {"malformed": 2, "dropped": 2}}


def test_legacy_chinese_encoding(spark, tmp_dir):
    p = os.path.join(tmp_dir, "secumain.csv")
    _write(p, "1,黄金基金,黄金,8,1\n", encoding="gbk")
    with pytest.raises(ValueError, match="javaCharsets"):
        readers.read_extract(spark, "secumain", p, encoding="cp936")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        row = readers.read_extract(spark, "secumain", p, encoding="cp936").collect()[0]
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")
    assert row.ChiName == "黄金基金" and row.SecuCategory == 8


def test_validate_drops_rows_without_key(spark):
    df = spark.createDataFrame([(None, 1, dt.date(2000, 1, 1)), (1, 2, dt.date(2000, 1, 1))], schemas.FUNDTYPECHANGENEW)
    assert readers.validate(df, "fundtypechangenew").count() == 1


def test_partitioned_sink_is_idempotent_per_end_date(spark, tmp_dir):
    out = os.path.join(tmp_dir, "rating")
    def frame(end, n, status):
        return spark.range(n).select(F.col("id").cast("int").alias("InnerCode"), F.lit(status).alias("FundSizeStatus"),
                                     F.lit(0).alias("SDStatus"), F.lit("R3").alias("HigherRiskLevel"),
                                     F.lit("中等").alias("HigherRiskLevelName"), F.lit(end).alias("EndDate"))
    q3, q4 = dt.date(2000, 9, 30), dt.date(2000, 12, 31)
    sinks.write_rating(frame(q3, 3, 1), out)
    sinks.write_rating(frame(q4, 5, 0), out)
    sinks.write_rating(frame(q4, 4, 1), out)      # re-run of Q4 replaces only Q4
    prev = sinks.read_previous_state(spark, out, q3)
    assert prev.count() == 3 and {r.FundSizeStatus for r in prev.collect()} == {1}
    assert sinks.read_previous_state(spark, out, q4).count() == 4
    plan = prev._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(EndDate" in plan


def test_replacing_a_date(spark, tmp_dir):
    out = os.path.join(tmp_dir, "dated")
    q3, q4 = dt.date(2000, 9, 30), dt.date(2000, 12, 31)
    frame = lambda n, s: spark.range(n).select(F.col("id").cast("int").alias("InnerCode"), F.lit(s).alias("S"))
    table = lambda fmt, path: sorted((str(r.EndDate), int(r.InnerCode), int(r.S)) for r in spark.read.format(fmt).option("header", True).load(path).collect())
    for fmt in ("parquet", "csv"):
        path = f"{out}-{fmt}"
        sinks.replace_date(frame(2, 1), path, q3, fmt)
        sinks.replace_date(frame(3, 2), path, q4, fmt)
        sinks.replace_date(frame(1, 3), path, q4, fmt)
        assert table(fmt, path) == [("2000-09-30", 0, 1), ("2000-09-30", 1, 1), ("2000-12-31", 0, 3)]
        # a job that fails while it computes, or is refused, leaves the old rows
        bad = frame(5, 4).withColumn("S", F.when(F.col("InnerCode") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("S")).cast("int"))
        with pytest.raises(Exception, match="broken"):
            sinks.replace_date(bad, path, q4, fmt)
        def refuse():
            raise ValueError("refused")
        with pytest.raises(ValueError, match="refused"):
            sinks.replace_date(frame(9, 5), path, q4, fmt, refuse)
        assert table(fmt, path)[-1] == ("2000-12-31", 0, 3)
        # a run without rows empties its own date and no other
        assert sinks.replace_date(frame(0, 6), path, q4, fmt).count() == 0
        assert table(fmt, path) == [("2000-09-30", 0, 1), ("2000-09-30", 1, 1)]
        assert os.path.isdir(f"{path}/EndDate=2000-12-31")
        sinks.replace_date(frame(1, 7), path, q4, fmt)
        assert table(fmt, path)[-1] == ("2000-12-31", 0, 7)


def test_local_table_has_known_size_and_escapes(spark):
    df = local_table(spark, [(1, "it's", dt.date(2000, 1, 1)), (2, "back\\slash", None)], "a int, b string, c date")
    assert [tuple(r) for r in df.collect()] == [(1, "it's", dt.date(2000, 1, 1)), (2, "back\\slash", None)]
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1000


def test_checkpoint_dir_comes_from_session(spark, tmp_dir):
    from riskladder.session import ensure_checkpoint_dir, materialize
    current = ensure_checkpoint_dir(spark)
    assert current and ensure_checkpoint_dir(spark, fallback=tmp_dir) == current   # never replaced once set
    df = materialize(spark.range(10).filter("id % 2 = 0"))
    assert df.count() == 5 and "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()


def test_risk_mapping_from_csv_and_yaml(spark, tmp_dir):
    from riskladder.functions import lookups as L
    rows = L.BASIC_RISK_LEVEL[:3]
    csv = os.path.join(tmp_dir, "mapping.csv")
    _write(csv, "FundTypeName1,FundTypeName2,FundTypeName3,RiskLevel\n" + "".join(",".join(r) + "\n" for r in rows))
    got = sorted(tuple(r) for r in L.read_risk_mapping(spark, csv).collect())
    assert got == sorted(rows)
    yml = os.path.join(tmp_dir, "mapping.yaml")
    body = ", ".join("[" + ", ".join(f'"{v}"' for v in r) + "]" for r in rows)
    _write(yml, "fund_risk_estimate:\n  basic_risk_level: [" + body + "]\n")
    got = sorted(tuple(r) for r in L.read_risk_mapping(spark, yml, "InitialRiskLevel").collect())
    assert got == sorted(rows)
    assert L.read_risk_mapping(spark, yml, "InitialRiskLevel").columns[-1] == "InitialRiskLevel"
