"""Arithmetic with BLANK semantics of the report model, as Spark columns.

BLANK is represented by SQL NULL.  The rules:
  * ``a - b`` treats a single BLANK as 0, but BLANK - BLANK is BLANK.
  * ``safe_div(a, b)`` is BLANK when b is 0 or BLANK; with ``alt`` given the
    result is ``alt`` instead.
  * ``x = BLANK`` comparisons are also true for 0 (``is_blank_or_zero``).
  * distinct counts count BLANK as one member.
Money sums are exact decimals; ratios are computed in double from them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_sub(a: Column, b: Column) -> Column:
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))


def safe_div(a: Column, b: Column) -> Column:
    """DIVIDE(a, b): BLANK when b is 0 or BLANK."""
    a = a.cast("double")
    b = b.cast("double")
    return F.when(b.isNull() | (b == 0), F.lit(None).cast("double")).otherwise(a / b)


def divide_alt(a: Column, b: Column, alt: float) -> Column:
    """DIVIDE(a, b, alt): alt when b is 0/BLANK; BLANK numerator gives BLANK."""
    a = a.cast("double")
    b = b.cast("double")
    return F.when(b.isNull() | (b == 0), F.lit(float(alt))).otherwise(a / b)


def weekly_pct_change(ty: Column, ly: Column) -> Column:
    """abs(TY / LY) - 1, BLANK when the ratio is BLANK or the change is -1."""
    ratio = safe_div(ty, ly)
    x = F.abs(ratio) - F.lit(1.0)
    return F.when(x == -1.0, F.lit(None).cast("double")).otherwise(x)


def ytd_pct_change(ty: Column, ly: Column) -> Column:
    """DIVIDE(TY - LY, abs(LY), 0)."""
    ch = blank_sub(ty, ly).cast("double")
    return divide_alt(ch, F.abs(ly.cast("double")), 0.0)


def abs_ratio_change(x: Column, y: Column) -> Column:
    """DIVIDE(x - y, ABS(y)): BLANK when y is 0/BLANK (month-to-date %)."""
    return safe_div(blank_sub(x, y), F.abs(y.cast("double")))


def ratio_change(x: Column, y: Column) -> Column:
    """DIVIDE(x - y, y): BLANK when y is 0/BLANK."""
    return safe_div(blank_sub(x, y), y)


def sign_class(x: Column) -> Column:
    """-1 / 0 / 1 with 0 covering both 0 and BLANK."""
    return (F.when(x < 0, F.lit(-1)).when(x > 0, F.lit(1)).otherwise(F.lit(0))).cast("int")


def is_blank_or_zero(x: Column) -> Column:
    return x.isNull() | (x == 0)


def distinct_with_blank(c: Column) -> Column:
    """Distinct count where NULL counts as one member."""
    return (F.count_distinct(c) + F.max(F.when(c.isNull(), F.lit(1)).otherwise(F.lit(0)))).cast("long")


def selected_value(c: Column) -> Column:
    """The single visible value, else BLANK (aggregate expression): the least
    is the greatest, so no distinct values are shuffled."""
    return F.when(F.min(c) == F.max(c), F.min(c))


def money(c: Column) -> Column:
    """Report money type used for every sum (exact, reproducible)."""
    return c.cast("decimal(18,2)")
