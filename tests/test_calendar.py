import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskladder.functions import calendar as C

D = dt.date


@pytest.mark.parametrize("as_of, ends", [
    (D(2001, 2, 15), (D(2000, 12, 31), D(2000, 9, 30), D(2000, 6, 30), D(2000, 3, 31))),
    (D(2022, 1, 20), (D(2021, 12, 31), D(2021, 9, 30), D(2021, 6, 30), D(2021, 3, 31))),
    (D(2022, 5, 10), (D(2022, 3, 31), D(2021, 12, 31), D(2021, 9, 30), D(2021, 6, 30))),
    (D(2022, 8, 1), (D(2022, 6, 30), D(2022, 3, 31), D(2021, 12, 31), D(2021, 9, 30))),
    (D(2022, 11, 30), (D(2022, 9, 30), D(2022, 6, 30), D(2022, 3, 31), D(2021, 12, 31))),
    (D(2022, 4, 1), (D(2022, 3, 31), D(2021, 12, 31), D(2021, 9, 30), D(2021, 6, 30))),
])
def test_rating_dates(as_of, ends):
    r = C.rating_dates(as_of)
    assert r.quarter_ends == ends
    assert r.d5 == ends[0].replace(year=ends[0].year - 1)
    assert (r.d6, r.d7, r.d8, r.d9) == tuple(e.replace(year=e.year - 3) for e in ends)


def test_column_quarter_ends_agree_with_driver_helper(spark):
    days = [D(2000, 1, 1) + dt.timedelta(days=37 * i) for i in range(80)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    out = df.select("d", *[C.quarter_end_before(F.col("d"), k).alias(f"q{k}") for k in range(4)]).collect()
    for r in out:
        assert (r.q0, r.q1, r.q2, r.q3) == C.rating_dates(r.d).quarter_ends


def test_week_number_around_anchor(spark):
    df = spark.createDataFrame([(D(2018, 2, 25),), (D(2018, 2, 26),), (D(2018, 3, 4),), (D(2018, 3, 5),),
                                (D(2018, 2, 19),), (D(2018, 2, 18),)], "d date")
    assert [r[0] for r in df.select(C.week_number(F.col("d"))).collect()] == [-1, 0, 0, 1, -1, -2]


def test_tenure_months_month_end_rule(spark):
    df = spark.createDataFrame([(D(1999, 6, 30),), (D(1999, 7, 1),), (D(1997, 6, 30),), (D(1997, 5, 31),),
                                (D(1997, 5, 30),)], "d date")
    out = [r[0] for r in df.select(C.tenure_months(D(2000, 12, 31), F.col("d"))).collect()]
    assert out == [18.0, 17.96774194, 42.0, 43.0, 43.03225806]


def test_windows_are_half_open(spark):
    r = C.rating_dates(D(2001, 2, 15))
    df = spark.createDataFrame([(r.d6,), (r.d1,), (r.d6 + dt.timedelta(days=1),)], "d date")
    assert [x[0] for x in df.select(C.in_window(F.col("d"), r.d6, r.d1)).collect()] == [False, True, True]
