"""Text helpers for feed and coverage cleaning (all built-in functions)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Chain-name fix-ups applied in this order to the coverage
# file's chain column before it is matched to the retailer order table.
CHAIN_REPLACEMENTS = [("CVS Corp", "CVS"), ("Walgreen Co", "Walgreens"), ("Wal Mart", "Walmart")]

# The district-manager fix-up (two no-break spaces -> 'non',
# then 'nan' -> '', then 'non' -> '').
DISTRICT_MANAGER_REPLACEMENTS = [("\u00a0\u00a0", "non"), ("nan", ""), ("non", "")]


def clean_text(c: Column) -> Column:
    """Trim, then remove control characters (0x00-0x1F and 0x7F-0x9F)."""
    return F.regexp_replace(F.trim(c), r"[\x00-\x1F\x7F-\x9F]", "")


def replace_in_order(c: Column, pairs) -> Column:
    """Substring replacements applied one after another."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def nan_to_null(c: Column) -> Column:
    return F.when(c == F.lit("nan"), F.lit(None).cast("string")).otherwise(c)


def nan_to_empty(c: Column) -> Column:
    """Substring 'nan' -> '' (the coverage fix-up replaces text, not cells)."""
    return F.replace(c, F.lit("nan"), F.lit(""))


def number_text(x: Column) -> Column:
    """Number -> text without a trailing '.0' or exponent (123.0 -> '123',
    123.5 -> '123.5', 12345678.0 -> '12345678')."""
    s = x.cast("decimal(38,6)").cast("string")
    return F.when(F.instr(s, ".") > 0, F.regexp_replace(F.regexp_replace(s, "0+$", ""), r"\.$", "")).otherwise(s)


def split_part(c: Column, delim: str, idx: int) -> Column:
    """Part ``idx`` (1-based) of a split on the FIRST ``delim`` only; NULL
    when absent.  Safe under ANSI mode (no out-of-bounds error)."""
    parts = F.split(c, F.lit(re.escape(delim)), 2)
    return F.try_element_at(parts, F.lit(idx))


def feed_store_number(store_text: Column) -> Column:
    """Feed side: split on every '#', keep the first two parts as integers
    (unconvertible parts become NULL), concatenate them and read the result
    as a number ('011#00045' -> 1145, '12#34#56' -> 1234)."""
    parts = F.split(store_text, F.lit("#"))
    p1 = F.try_element_at(parts, F.lit(1)).try_cast("bigint")
    p2 = F.try_element_at(parts, F.lit(2)).try_cast("bigint")
    return F.nullif(F.concat_ws("", p1.cast("string"), p2.cast("string")), F.lit("")).try_cast("double")


def fact_store_part(store_number: Column) -> Column:
    """Fact side: store number -> text, split on '.', each part as an
    integer, parts concatenated (nulls skipped)."""
    txt = number_text(store_number)
    p1 = split_part(txt, ".", 1).try_cast("bigint")
    p2 = split_part(txt, ".", 2).try_cast("bigint")
    return F.nullif(F.concat_ws("", p1.cast("string"), p2.cast("string")), F.lit(""))


def coverage_store_part(store_num_text: Column) -> Column:
    """Coverage side: 'a#b' -> integer(a) followed by 'b.' when b is present,
    read back as a number, then as text."""
    p1 = split_part(store_num_text, "#", 1).try_cast("bigint")
    p2 = split_part(store_num_text, "#", 2)
    custom = F.when(p2.isNull(), F.lit(None).cast("string")).otherwise(F.concat(p2, F.lit(".")))
    merged = F.nullif(F.concat_ws("", p1.cast("string"), custom), F.lit(""))
    return number_text(merged.try_cast("decimal(38,6)"))


def join_key(store_part: Column, order: Column) -> Column:
    """Store digits followed by the retailer order digit, as a bigint.
    A NULL store part keeps a NULL key (rather than the order alone)."""
    return F.when(store_part.isNull(), F.lit(None).cast("bigint")).otherwise(
        F.concat_ws("", store_part, order.cast("string")).try_cast("bigint"))
