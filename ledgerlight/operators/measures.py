"""Time-window sales measures.

A report selection (year, week, N ...) resolves on the driver into a dict
of named closed date ranges.  ``window_sums`` then evaluates every window
in ONE pass over the fact:

1. the fact is read with the envelope of all windows as a pushed-down scan
   filter (row groups outside every window are skipped);
2. lines are pre-aggregated at the store (and, when asked for, product)
   grain with one conditional sum per window -- a hash aggregate with a
   map-side partial step, so hot keys collapse before the shuffle and the
   shuffle carries one row per key instead of one per line.  The product is
   attached before: grouping by store and part would hardly reduce lines;
3. the store dimension, if its columns are asked for, is joined (left, so
   unmatched fact rows keep a blank member) on the already-reduced rows;
4. a final aggregate by the report's grouping columns.

Sums are exact ``decimal(18,2)``; callers cast to double at the edge.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blanks as B
from ..functions.calendar import (EMPTY, DateRange, add_months, anchor_week_ending, envelope,
                                  last_day_of_week, monday_start_py, same_period_last_year, year_to_week)
from ..sources import retail as R
from ..sources.tables import Tables

WEEK_CHOICES = (1, 4, 13, 26, 52)
YTD_CHOICE = 9999


@dataclass(frozen=True)
class Selection:
    """The report's slicer state: one year and one week."""
    year: int
    week: int

    @property
    def last_date(self) -> _dt.date | None:
        """MAX(date) visible under the selection."""
        return last_day_of_week(self.year, self.week)


# ----------------------------------------------------------- window rules

def selected_week_window(sel: Selection) -> DateRange:
    """The days the slicer itself selects: year Y, week W."""
    from ..functions.calendar import py_week_no
    last = sel.last_date
    if last is None:
        return EMPTY
    first = last
    while first.day > 1 or first.month > 1:
        prev = first - _dt.timedelta(days=1)
        if py_week_no(prev) != sel.week:
            break
        first = prev
    return DateRange(first, last)


def sole_choice(selected, default):
    """A parameter's value: the only one selected, else the default."""
    return next(iter(selected)) if len(set(selected)) == 1 else default


def greatest_choice(selected, choices):
    """A parameter's greatest value in sight; without a selection all are."""
    return max(selected or choices)


def weekly_window(sel: Selection, n_weeks: int, last_year: bool = False) -> DateRange:
    """N weeks ending on the selected week's week-ending (TY) or on the same
    week of the previous year (LY).  9999 means year-to-week."""
    year = sel.year - 1 if last_year else sel.year
    if n_weeks == YTD_CHOICE:
        return year_to_week(year, sel.week)
    if n_weeks not in WEEK_CHOICES:
        return EMPTY
    end = anchor_week_ending(year, sel.week)
    if end is None:
        return EMPTY
    return DateRange(end - _dt.timedelta(days=7 * n_weeks - 1), end)


def ytd_window(sel: Selection, last_year: bool = False) -> DateRange:
    return year_to_week(sel.year - 1 if last_year else sel.year, sel.week)


def mtd_window(sel: Selection, last_year: bool = False) -> DateRange:
    end = sel.last_date
    if end is None:
        return EMPTY
    if last_year:
        end = same_period_last_year(end)
    return DateRange(end.replace(day=1), end)


def calendar_ytd_window(sel: Selection, last_year: bool = False) -> DateRange:
    end = sel.last_date
    if end is None:
        return EMPTY
    if last_year:
        end = same_period_last_year(end)
    return DateRange(_dt.date(end.year, 1, 1), end)


def last_n_months_window(sel: Selection, n_months: int = 13) -> DateRange:
    end = sel.last_date
    if end is None:
        return EMPTY
    return DateRange(add_months(end, -(n_months - 1)).replace(day=1), end)


def prior_n_months_window(sel: Selection, n_months: int = 13) -> DateRange:
    end = sel.last_date
    if end is None:
        return EMPTY
    return DateRange(add_months(end, -12 - (n_months - 1)).replace(day=1), add_months(end, -12))


def week_ending_window(sel: Selection, n_weeks: int) -> DateRange:
    """Week endings in [end - 7N, end]: N+1 whole weeks of days."""
    if n_weeks == YTD_CHOICE:
        return ytd_window(sel)
    end = anchor_week_ending(sel.year, sel.week)
    if end is None:
        return EMPTY
    return DateRange(end - _dt.timedelta(days=7 * n_weeks + 6), end)


def prior_n_weeks_window(sel: Selection, n_weeks: int) -> DateRange:
    """N weeks ending 365 days before the selection's last date."""
    if n_weeks == YTD_CHOICE:
        return ytd_window(sel, last_year=True)
    last = sel.last_date
    if last is None:
        return EMPTY
    end = last - _dt.timedelta(days=365)
    return DateRange(end - _dt.timedelta(days=7 * (n_weeks - 1)), end)


def last_n_days_window(sel: Selection, n_weeks: int) -> DateRange:
    """From last date - 7N to the last date (7N + 1 days)."""
    last = sel.last_date
    if last is None:
        return EMPTY
    return DateRange(last - _dt.timedelta(days=7 * n_weeks), last)


def rolling_7d_window(sel: Selection) -> DateRange:
    last = sel.last_date
    if last is None:
        return EMPTY
    return DateRange(last - _dt.timedelta(days=6), last)


# Monday-aligned week family: last-year windows exist for these lengths.
MONDAY_LY_WEEKS = (1, 4, 26, 52)


def monday_ly_window(sel: Selection, n_weeks: int) -> DateRange:
    """N whole weeks ending with the selected Monday-aligned week of last
    year (starts 7 * (N - 1) days before that week)."""
    if n_weeks not in MONDAY_LY_WEEKS or (n_weeks == 1 and sel.week == 53):
        return EMPTY
    start = monday_start_py(sel.year - 1, sel.week)
    return DateRange(start - _dt.timedelta(days=7 * (n_weeks - 1)), start + _dt.timedelta(days=6))


def monday_prev13_window(sel: Selection) -> DateRange:
    """The 13 weeks before the current Monday-aligned week, this year."""
    start = monday_start_py(sel.year, sel.week)
    return DateRange(start - _dt.timedelta(days=91), start - _dt.timedelta(days=1))


def monday_forward_window(sel: Selection, n_weeks: int) -> DateRange:
    """N weeks running forward from the Monday-aligned week; blank for 53."""
    if sel.week == 53 or n_weeks not in WEEK_CHOICES:
        return EMPTY
    start = monday_start_py(sel.year, sel.week)
    return DateRange(start, start + _dt.timedelta(days=7 * n_weeks - 1))


# Selector order 0..4 of the "last N weeks" parameter -> N.
MONDAY_DISPATCH = {0: 1, 1: 4, 2: 13, 3: 26, 4: 52}


def monday_dispatch_window(sel: Selection, order: int) -> DateRange:
    n = MONDAY_DISPATCH.get(order)
    if n is None:
        return EMPTY
    return monday_prev13_window(sel) if n == 13 else monday_ly_window(sel, n)


# ------------------------------------------------------------- evaluation

def week_end_date(sel: Selection) -> _dt.date | None:
    """Last date of the selected year whose plain WEEKNUM is the selected
    week and whose retail week is not 53 (None when there is none)."""
    from ..functions.calendar import py_week_no
    days = []
    d = _dt.date(sel.year, 1, 1)
    jan1_dow = (d.isoweekday() % 7) + 1
    while d.year == sel.year:
        plain = (d.timetuple().tm_yday + jan1_dow - 2) // 7 + 1
        if plain == sel.week and py_week_no(d) != 53:
            days.append(d)
        d += _dt.timedelta(days=1)
    return max(days) if days else None


GROUPABLE = ("retailer", "retailer_order", "smm", "ssr", "ssr_name", "smm_territory", "store", "store_name",
             "in_coverage", "product", "part_key", "sale_date")


def _cond_sums(windows: dict[str, DateRange], date_col: str = "sale_date", value_col: str = "value"):
    return [F.sum(F.when(r.contains(F.col(date_col)), F.col(value_col))).alias(n) for n, r in windows.items()]


def window_sums(t: Tables, windows: dict[str, DateRange], by, where: Column | None = None,
                where_cols=(), extra_aggs=None) -> DataFrame:
    """All windows of the POS fact, grouped by ``by`` (dimension or fact
    columns), evaluated in one scan.  ``where`` is a selection on dimension
    columns (listed in ``where_cols``).  When it touches one dimension only,
    it is applied to that dimension and reaches the fact as a semi join on
    the fact's key, below the pre-aggregation, so only the selected lines
    are aggregated and shuffled."""
    from ..sources.params import check_group_cols
    by = check_group_cols(by, GROUPABLE)
    where_cols = set(where_cols)
    env = envelope(windows.values())
    lines = R.sales_lines(t, env)
    post_filter = None
    if where is not None and where_cols and where_cols <= set(R.PRODUCT_ATTRS):
        lines = lines.join(R.product_dim(t).where(where).select("part_key"), "part_key", "left_semi")
    elif where is not None and where_cols and where_cols <= set(R.STORE_ATTRS):
        lines = lines.join(R.store_dim(t).where(where).select("store"), "store", "left_semi")
    elif where is not None:
        post_filter = where
    needed = set(by) | (where_cols if post_filter is not None else set())
    # Pre-aggregation grain: the store for store attributes, and the product
    # attributes themselves.
    products = sorted(needed & set(R.PRODUCT_ATTRS))
    if products:
        lines = R.attach_dims(lines, t, products)
    grain = list(products)
    if needed & set(R.STORE_ATTRS) or "store" in needed:
        grain.append("store")
    grain += [c for c in ("part_key", "sale_date") if c in needed]
    aggs = _cond_sums(windows)
    if extra_aggs:
        aggs += extra_aggs(pre=True)
    pre = lines.groupBy(*grain).agg(*aggs)
    fact = R.attach_dims(pre, t, needed & set(R.STORE_ATTRS))
    if post_filter is not None:
        fact = fact.where(post_filter)
    final = [F.sum(n).alias(n) for n in windows]
    if extra_aggs:
        final += extra_aggs(pre=False)
    return fact.groupBy(*by).agg(*final)


def category_window_sums(t: Tables, windows: dict[str, DateRange], by=("category",)) -> DataFrame:
    """Windows of the category fact: pre-aggregated per customer, then the
    segment is attached and the windows summed per ``by``."""
    env = envelope(windows.values())
    pre = R.category_lines(t, env).groupBy("store").agg(*_cond_sums(windows))
    fact = R.join_dim(pre, R.category_dim(t), "store")
    return fact.groupBy(*by).agg(*[F.sum(n).alias(n) for n in windows])


def with_change(df: DataFrame, ty: str, ly: str, prefix: str, pct: str = "weekly") -> DataFrame:
    """Add ``{prefix}_change`` (TY - LY) and ``{prefix}_pct`` columns."""
    t, l = F.col(ty), F.col(ly)
    df = df.withColumn(f"{prefix}_change", B.blank_sub(t, l).cast("double"))
    if pct == "weekly":
        df = df.withColumn(f"{prefix}_pct", B.weekly_pct_change(t, l))
    elif pct == "ytd":
        df = df.withColumn(f"{prefix}_pct", B.ytd_pct_change(t, l))
    elif pct == "mtd":
        df = df.withColumn(f"{prefix}_pct", B.abs_ratio_change(t, l))
    elif pct == "ratio":
        df = df.withColumn(f"{prefix}_pct", B.ratio_change(t, l))
    return df


def as_double(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def weekly_anchored_sums(t: Tables, anchors_from, anchors_to, n_weeks: int, by) -> DataFrame:
    """Sum of the N weeks ending on every Saturday anchor in
    [anchors_from, anchors_to], per ``by``, in one pass: lines are
    pre-aggregated to (store, week ending), then to (``by``, week ending),
    and each of those rows is exploded into the N anchors whose window
    contains it (a bounded fan-out, no join of windows against lines)."""
    from ..functions.calendar import week_ending
    by = list(by)
    env = DateRange(anchors_from - _dt.timedelta(days=7 * n_weeks - 1), anchors_to)
    lines = R.sales_lines(t, env)
    weekly = lines.groupBy("store", week_ending(F.col("sale_date")).alias("we")).agg(F.sum("value").alias("v"))
    weekly = R.attach_dims(weekly, t, set(by)).groupBy(*by, "we").agg(F.sum("v").alias("v"))
    anchored = weekly.select(
        *by, "v",
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(n_weeks - 1)),
                              lambda k: F.date_add(F.col("we"), k * 7))).alias("anchor"))
    anchored = anchored.where(F.col("anchor").between(F.lit(anchors_from), F.lit(anchors_to)))
    return anchored.groupBy(*by, "anchor").agg(F.sum("v").alias("sales"))
