"""Retail-week calendar.

Two kinds of helpers live here:

* Column expressions (``week_no``, ``week_ending`` ...) evaluated by Spark
  on every fact or calendar row.  They are plain built-in functions, so
  they stay inside whole-stage codegen.
* Parameter arithmetic (``anchor_week_ending``, ``DateRange`` ...) that turns
  a report selection (year, week, N) into literal date bounds on the
  driver.  Literal bounds let Catalyst push ``sale_date BETWEEN a AND b``
  into the parquet scan, so a window over two years of a long history reads
  only those row groups.  The arithmetic is the same rule as the column
  expressions and the tests check one against the other day by day.

Week rule (Sunday-start weeks): week 1 holds January 1st; when January 1st
is a Saturday the whole year is shifted down by one, so that day is week 0.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


# ---------------------------------------------------------------- columns

def dow(d: Column) -> Column:
    """Weekday number, Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(d)


def week_no(d: Column) -> Column:
    """Retail week number of a date (see module docstring)."""
    jan1_dow = F.dayofweek(F.make_date(F.year(d), F.lit(1), F.lit(1)))
    raw = F.floor((F.dayofyear(d) + jan1_dow - F.lit(2)) / F.lit(7)).cast("int") + F.lit(1)
    return F.when(jan1_dow == 7, raw - 1).otherwise(raw).cast("int")


def plain_weeknum(d: Column) -> Column:
    """Sunday-start week number with week 1 holding January 1st, without the
    Saturday shift (the plain WEEKNUM some measures compare against)."""
    jan1_dow = F.dayofweek(F.make_date(F.year(d), F.lit(1), F.lit(1)))
    return (F.floor((F.dayofyear(d) + jan1_dow - F.lit(2)) / F.lit(7)).cast("int") + F.lit(1)).cast("int")


def week_ending(d: Column) -> Column:
    """The Saturday closing the Sunday-start week of ``d``."""
    return F.date_add(d, (F.lit(7) - F.dayofweek(d)).cast("int"))


def monday_week_start(year: Column, week: Column) -> Column:
    """Start of the Monday-aligned week used by the Monday-week measures:
    the Monday on or before ``Jan 1 + 7 * (week - 1)``."""
    ws = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), ((week - 1) * 7).cast("int"))
    return F.date_sub(ws, F.weekday(ws))


def leap_year(y: Column) -> Column:
    return ((y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0)))


def quarter_label(m: Column) -> Column:
    return (F.when(m < 4, "QTR 1").when(m < 7, "QTR 2").when(m < 10, "QTR 3").otherwise("QTR 4"))


# ------------------------------------------------------ driver arithmetic

def py_week_no(d: _dt.date) -> int:
    jan1 = _dt.date(d.year, 1, 1)
    jan1_dow = (jan1.isoweekday() % 7) + 1          # Sunday = 1
    raw = (d.timetuple().tm_yday + jan1_dow - 2) // 7 + 1
    return raw - 1 if jan1_dow == 7 else raw


def py_week_ending(d: _dt.date) -> _dt.date:
    return d + _dt.timedelta(days=7 - ((d.isoweekday() % 7) + 1))


def _days_of_year(year: int):
    d = _dt.date(year, 1, 1)
    while d.year == year:
        yield d
        d += _dt.timedelta(days=1)


def anchor_week_ending(year: int, week: int) -> _dt.date | None:
    """Largest week ending among the days of ``year`` whose week number is
    ``week``; None when the year has no such week."""
    ends = [py_week_ending(d) for d in _days_of_year(year) if py_week_no(d) == week]
    return max(ends) if ends else None


def last_day_of_week(year: int, week: int) -> _dt.date | None:
    """Last calendar day of ``year`` whose week number is ``week`` (the
    anchor date of a (year, week) selection: MAX(date) in the selection)."""
    days = [d for d in _days_of_year(year) if py_week_no(d) == week]
    return max(days) if days else None


def add_months(d: _dt.date, n: int) -> _dt.date:
    """Month arithmetic with end-of-month clamping (EDATE / add_months)."""
    y, m = divmod(d.month - 1 + n, 12)
    y += d.year
    m += 1
    for day in (d.day, 30, 29, 28):
        try:
            return _dt.date(y, m, min(d.day, day))
        except ValueError:
            continue
    raise ValueError(d)


def same_period_last_year(d: _dt.date) -> _dt.date:
    """Shift a range end back one year the way a same-period-last-year
    shift does: a month's last day maps to that month's last day a year
    earlier (Feb 28, 2001 -> Feb 29, 2000); other days keep the day,
    clamped to the month (unlike ``add_months`` for the first rule)."""
    nxt = d + _dt.timedelta(days=1)
    if nxt.month != d.month:                      # d is the last day of its month
        first_next = _dt.date(d.year - 1 + (d.month // 12), d.month % 12 + 1, 1)
        return first_next - _dt.timedelta(days=1)
    return add_months(d, -12)


@dataclass(frozen=True)
class DateRange:
    """Closed date interval; ``start`` None means the window is empty."""
    start: _dt.date | None
    end: _dt.date | None

    @property
    def empty(self) -> bool:
        return self.start is None or self.end is None or self.start > self.end

    def contains(self, d: Column) -> Column:
        if self.empty:
            return F.lit(False)
        return d.between(F.lit(self.start), F.lit(self.end))

    def sql(self, col: str) -> str:
        if self.empty:
            return "FALSE"
        return f"{col} BETWEEN DATE '{self.start}' AND DATE '{self.end}'"


EMPTY = DateRange(None, None)


def envelope(ranges) -> DateRange:
    """Smallest range covering every non-empty range (used as the scan
    prefilter so the parquet reader skips row groups outside all windows)."""
    live = [r for r in ranges if not r.empty]
    if not live:
        return EMPTY
    return DateRange(min(r.start for r in live), max(r.end for r in live))


def year_to_week(year: int, week: int) -> DateRange:
    """Days of ``year`` with week number <= ``week`` (a prefix of the year,
    because week numbers never decrease inside a year)."""
    days = [d for d in _days_of_year(year) if py_week_no(d) <= week]
    return DateRange(min(days), max(days)) if days else EMPTY


def monday_start_py(year: int, week: int) -> _dt.date:
    """Driver-side twin of ``monday_week_start``."""
    ws = _dt.date(year, 1, 1) + _dt.timedelta(days=7 * (week - 1))
    return ws - _dt.timedelta(days=ws.weekday())
