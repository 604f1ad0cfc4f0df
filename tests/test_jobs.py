import datetime as dt
import os

from pyspark.sql import functions as F

from riskladder.plans import catalog
from riskladder.plans.jobs import DAILY_INPUTS, QUARTERLY_INPUTS, daily_job, quarterly_job
from tests_helpers_extracts import write_extracts

SF = "/root/testdata/sf0.001"


def _write_extracts(spark, folder, names):
    write_extracts(spark, folder, names, SF)


def test_quarterly_job_with_state_from_previous_run(spark, tmp_dir):
    ex, out = os.path.join(tmp_dir, "extracts"), os.path.join(tmp_dir, "rating")
    _write_extracts(spark, ex, QUARTERLY_INPUTS)
    first = quarterly_job(spark, ex, dt.date(2000, 11, 15), out)
    assert first.count() > 0
    # second quarter: no last_qrt extract, state comes from the first run's partition
    ex2 = os.path.join(tmp_dir, "extracts2")
    _write_extracts(spark, ex2, [n for n in QUARTERLY_INPUTS if n != "last_qrt"])
    quarterly_job(spark, ex2, dt.date(2001, 2, 15), out, state_path=out)
    table = spark.read.parquet(out)
    ends = sorted(r.EndDate for r in table.select("EndDate").distinct().collect())
    assert ends == [dt.date(2000, 9, 30), dt.date(2000, 12, 31)]
    # rerunning Q4 is idempotent
    before = table.filter(F.col("EndDate") == dt.date(2000, 12, 31)).count()
    quarterly_job(spark, ex2, dt.date(2001, 2, 15), out, state_path=out)
    assert spark.read.parquet(out).filter(F.col("EndDate") == dt.date(2000, 12, 31)).count() == before
    assert spark.read.parquet(out).filter(F.col("EndDate") == dt.date(2000, 9, 30)).count() == first.count()


def test_quarterly_job_matches_registered_query(spark, tmp_dir):
    ex, out = os.path.join(tmp_dir, "extracts"), os.path.join(tmp_dir, "rating")
    _write_extracts(spark, ex, QUARTERLY_INPUTS)
    quarterly_job(spark, ex, catalog.AS_OF, out)
    cols = ["InnerCode", "RiskLevel", "BasicRiskLevel", "FundSizeStatus", "SDStatus", "ChangeReason"]
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(*cols).collect())
    want = sorted(tuple(r) for r in catalog.QUERIES["rating_quarterly"](spark, SF).select(*cols).collect())
    assert got == want


def test_history_job_replaces_every_quarter(spark, tmp_dir):
    from riskladder.__main__ import main
    ex, out, single = (os.path.join(tmp_dir, x) for x in ("extracts", "history", "single"))
    _write_extracts(spark, ex, QUARTERLY_INPUTS)
    main(["history", "--extracts", ex, "--as-of", "2000-11-15", "--through", "2001-02-28", "--out", out])
    quarterly_job(spark, ex, dt.date(2000, 11, 15), single)
    quarterly_job(spark, ex, dt.date(2001, 2, 15), single, state_path=single)
    rows = lambda p: sorted((tuple(r) for r in spark.read.parquet(p).drop("UpdateTime").collect()), key=repr)
    assert rows(out) == rows(single) and len(rows(out)) > 4
    # before any fund was founded: an empty date, the others stay
    main(["history", "--extracts", ex, "--as-of", "1990-05-15", "--out", out])
    assert rows(out) == rows(single) and os.path.isdir(f"{out}/EndDate=1990-03-31")


def test_quarterly_job_from_weekly_states(spark, tmp_dir):
    ex, out, weekly = (os.path.join(tmp_dir, x) for x in ("extracts", "rating", "weekly"))
    _write_extracts(spark, ex, QUARTERLY_INPUTS)
    quarterly_job(spark, ex, dt.date(2000, 11, 15), out, weekly_path=weekly, fill_weekly=True)
    quarterly_job(spark, ex, catalog.AS_OF, out, weekly_path=weekly)
    got = spark.read.parquet(out).filter(F.col("EndDate") == dt.date(2000, 12, 31))
    want = catalog.QUERIES["rating_quarterly"](spark, SF)
    cols = ["InnerCode", "RiskLevel", "LastQrtSD", "SecondQrtSD", "ThirdQrtSD", "ForthQrtSD", "FundSizeStatus", "SDStatus"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_daily_job(spark, tmp_dir):
    ex, out = os.path.join(tmp_dir, "extracts"), os.path.join(tmp_dir, "daily")
    _write_extracts(spark, ex, DAILY_INPUTS)
    daily_job(spark, ex, catalog.AS_OF, out)
    got = sorted(r.InnerCode for r in spark.read.parquet(out).collect())
    want = sorted(r.InnerCode for r in catalog.QUERIES["rating_daily"](spark, SF).collect())
    assert got == want


def test_command_line_quarterly(spark, tmp_dir):
    from riskladder.__main__ import main
    ex, out = os.path.join(tmp_dir, "extracts"), os.path.join(tmp_dir, "cli")
    _write_extracts(spark, ex, QUARTERLY_INPUTS)
    main(["quarterly", "--extracts", ex, "--as-of", "2001-02-15", "--out", out])
    table = spark.read.parquet(out)
    assert table.count() == catalog.QUERIES["rating_quarterly"](spark, SF).count()
    assert {r.EndDate for r in table.select("EndDate").distinct().collect()} == {dt.date(2000, 12, 31)}


def test_quarterly_state_from_csv_result_table(spark, tmp_dir):
    ex, out = os.path.join(tmp_dir, "extracts"), os.path.join(tmp_dir, "rating_csv")
    _write_extracts(spark, ex, QUARTERLY_INPUTS)
    first = quarterly_job(spark, ex, dt.date(2000, 11, 15), out, out_format="csv")
    ex2 = os.path.join(tmp_dir, "extracts2")
    _write_extracts(spark, ex2, [n for n in QUARTERLY_INPUTS if n != "last_qrt"])
    quarterly_job(spark, ex2, dt.date(2001, 2, 15), out, state_path=out, out_format="csv")
    table = spark.read.option("header", True).csv(out)
    assert table.filter(F.col("EndDate") == "2000-09-30").count() == first.count()
    assert table.filter(F.col("EndDate") == "2000-12-31").count() > 0


def test_job_with_mapping_file_matches_built_in_table(spark, tmp_dir):
    from riskladder.functions import lookups as L
    ex, out = os.path.join(tmp_dir, "extracts"), os.path.join(tmp_dir, "daily_mapped")
    _write_extracts(spark, ex, DAILY_INPUTS)
    mapping = os.path.join(tmp_dir, "mapping.csv")
    with open(mapping, "w", encoding="utf-8") as f:
        f.write("FundTypeName1,FundTypeName2,FundTypeName3,RiskLevel\n")
        f.writelines(",".join(r) + "\n" for r in L.BASIC_RISK_LEVEL)
    daily_job(spark, ex, catalog.AS_OF, out, mapping_path=mapping)
    cols = ["InnerCode", "InitialRiskLevel", "BasicRiskLevel", "SpecialType", "FundTypeCode"]
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(*cols).collect())
    want = sorted(tuple(r) for r in catalog.QUERIES["rating_daily"](spark, SF).select(*cols).collect())
    assert got == want


def test_paths_and_uris_give_the_same_daily_rating(spark, tmp_dir):
    import pytest
    ex = os.path.join(tmp_dir, "extracts")
    _write_extracts(spark, ex, DAILY_INPUTS)
    daily_job(spark, ex, catalog.AS_OF, os.path.join(tmp_dir, "a"))
    daily_job(spark, f"file://{ex}", catalog.AS_OF, os.path.join(tmp_dir, "b"))
    a, b = (sorted(map(str, spark.read.parquet(os.path.join(tmp_dir, x)).collect())) for x in "ab")
    assert a == b and a
    ex2 = os.path.join(tmp_dir, "extracts2")
    _write_extracts(spark, ex2, [n for n in DAILY_INPUTS if n != "fundtyperisklevel"])
    with pytest.raises(Exception):
        daily_job(spark, ex2, catalog.AS_OF, os.path.join(tmp_dir, "c"))


def test_jobs_report_bad_rows(spark, tmp_dir):
    import pytest
    ex = os.path.join(tmp_dir, "extracts")
    _write_extracts(spark, ex, DAILY_INPUTS)
    with open(os.path.join(ex, "secumain.csv", "part-extra.csv"), "w", encoding="utf-8") as f:
        f.write("900001,x,x,eight,1\nbad,x,x,8,1\n")
    report = {}
    daily_job(spark, ex, catalog.AS_OF, os.path.join(tmp_dir, "out"), report=report)
    assert report["secumain"] == {"malformed": 2, "dropped": 1} and report["fundtype"] == {"malformed": 0, "dropped": 0}
    with pytest.raises(ValueError, match="secumain"):
        daily_job(spark, ex, catalog.AS_OF, os.path.join(tmp_dir, "out2"), max_bad_rows=2)
    assert not os.path.exists(os.path.join(tmp_dir, "out2"))     # refused before the table was touched
    assert report["type_codes"]["keys"] > 0 and report["type_codes"]["rows"] >= report["type_codes"]["keys"]


def test_command_line_scans_every_extract_once(spark, tmp_dir):
    import json
    import subprocess
    import sys
    from collections import Counter
    ex, log = os.path.join(tmp_dir, "extracts"), os.path.join(tmp_dir, "events")
    os.mkdir(log)
    _write_extracts(spark, ex, QUARTERLY_INPUTS)
    conf = {"spark.master": "local[4]", "spark.ui.enabled": "false", "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log}",
            "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false", "spark.sql.shuffle.partitions": "4"}
    args = " ".join(f"--conf {k}={v}" for k, v in conf.items()) + " pyspark-shell"
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_GATEWAY")} | {"PYSPARK_SUBMIT_ARGS": args}
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-m", "riskladder", "quarterly", "--extracts", ex, "--as-of", "2001-02-15", "--out", os.path.join(tmp_dir, "out")],
                         cwd=top, env=env, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-2000:]
    plans = {}
    for name in os.listdir(log):
        for line in open(os.path.join(log, name), encoding="utf-8"):
            e = json.loads(line)
            if "sparkPlanInfo" in e:
                plans[e["executionId"]] = e["sparkPlanInfo"]     # the last is the one that ran
    scans = Counter()

    def walk(node):
        if node["nodeName"].startswith("Scan csv"):
            where = node.get("metadata", {}).get("Location", "") + node["simpleString"]
            scans.update({x for x in QUARTERLY_INPUTS if f"/{x}.csv" in where and "_strings" not in where})
        for child in node["children"]:
            walk(child)

    for p in plans.values():
        walk(p)
    assert scans == Counter(QUARTERLY_INPUTS), scans
