"""Rating calendar: quarter-ends, look-back windows, week buckets, tenure.

The run date is always an explicit ``as_of`` argument, never the wall clock, so
a rerun of any past date gives the same result.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: weeks are counted from this Monday (negative before it).
WEEK_ANCHOR = dt.date(2018, 2, 26)

QUARTER_LABELS = ("Last", "Second", "Third", "Forth")


def _quarter_end(year: int, quarter: int) -> dt.date:
    month = 3 * quarter
    nxt = dt.date(year + (month == 12), month % 12 + 1, 1)
    return nxt - dt.timedelta(days=1)


def _minus_years(d: dt.date, years: int) -> dt.date:
    return d.replace(year=d.year - years)   # quarter-ends never fall on 29 Feb


@dataclass(frozen=True)
class RatingDates:
    """D1..D4: the four quarter-ends before ``as_of`` (newest first);
    D5 = D1 - 1 year; D6..D9 = D1..D4 - 3 years."""
    as_of: dt.date
    d1: dt.date
    d2: dt.date
    d3: dt.date
    d4: dt.date
    d5: dt.date
    d6: dt.date
    d7: dt.date
    d8: dt.date
    d9: dt.date

    @property
    def quarter_ends(self) -> tuple[dt.date, dt.date, dt.date, dt.date]:
        return (self.d1, self.d2, self.d3, self.d4)

    @property
    def vol_windows(self) -> list[tuple[str, dt.date, dt.date]]:
        """(label, lo, hi) for the four half-open 3-year windows (lo, hi]."""
        return list(zip(QUARTER_LABELS, (self.d6, self.d7, self.d8, self.d9), self.quarter_ends))


def rating_dates(as_of: dt.date) -> RatingDates:
    """The nine rating dates for a run on ``as_of`` (computed on the driver: they are parameters)."""
    q = (as_of.month - 1) // 3 + 1          # quarter containing as_of
    ends = []
    y, k = as_of.year, q - 1
    for _ in range(4):
        if k == 0:
            y, k = y - 1, 4
        ends.append(_quarter_end(y, k))
        k -= 1
    d1, d2, d3, d4 = ends
    return RatingDates(as_of, d1, d2, d3, d4, _minus_years(d1, 1),
                       _minus_years(d1, 3), _minus_years(d2, 3),
                       _minus_years(d3, 3), _minus_years(d4, 3))


def quarter_end_before(d: Column, k: int = 0) -> Column:
    """Column form of D(k+1): the (k+1)-th quarter-end strictly before the quarter of ``d``."""
    return F.last_day(F.add_months(F.trunc(d, "quarter"), -1 - 3 * k))


def week_number(day: Column, anchor: dt.date = WEEK_ANCHOR) -> Column:
    """Whole weeks since the anchor Monday, floor division (negative before it)."""
    return F.floor(F.datediff(day, F.lit(anchor)) / 7)


def tenure_months(as_of: Column | dt.date, start: Column) -> Column:
    """Months between ``start`` and ``as_of`` (8-decimal, whole months at month-ends)."""
    end = F.lit(as_of) if isinstance(as_of, dt.date) else as_of
    return F.months_between(end, start)


def in_window(day: Column, lo: dt.date, hi: dt.date) -> Column:
    """Half-open (lo, hi]."""
    return (day > F.lit(lo)) & (day <= F.lit(hi))
