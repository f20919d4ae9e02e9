"""Data-quality operators: type-mismatch quarantine, key checks, rows per
key, coverage audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rank import global_row_number


def type_mismatch_quarantine(raw: DataFrame, target: dict, order_cols) -> DataFrame:
    """Number every row by ``order_cols`` (its position in the whole table;
    NULLs last, rows alike in all of them in any order, every row its own
    number), then keep only rows with at least one cell that is present but
    does not convert to its target type, row number first, with the failing
    columns listed.  (Failed conversions become NULL, never an error, as in
    a load that returns error values as null.)"""
    failed = {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in target.items()}
    any_failed = reduce(lambda a, b: a | b, failed.values())
    numbered = global_row_number(raw, order_cols, "row_no")
    bad = numbered.where(any_failed)
    return bad.select("row_no", *raw.columns,
                      F.concat_ws(",", *[F.when(cond, F.lit(c)) for c, cond in failed.items()]).alias("bad_columns"))


def key_checks(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, NULL keys, keys occurring more than once, largest
    occurrence."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    return per_key.agg(
        F.sum("_c").cast("long").alias("n_rows"),
        F.sum(F.when(F.col(key).isNull(), F.col("_c")).otherwise(0)).cast("long").alias("null_keys"),
        F.count(F.when(F.col(key).isNotNull() & (F.col("_c") > 1), F.lit(1))).cast("long").alias("dup_keys"),
        F.max(F.when(F.col(key).isNotNull(), F.col("_c"))).cast("long").alias("max_occurrence"))


def rows_per_key(df: DataFrame, key: str, out_col: str = "occurrence") -> DataFrame:
    """Rows sharing each row's key (NULL keys never match, count 0 ... here
    reported as NULL).  Aggregate-then-join, so a hot key is counted with a
    map-side partial aggregate rather than buffered in one window task."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).cast("long").alias(out_col))
    return df.join(counts, key, "left")


def coverage_flag(key: str, matched_col: str) -> F.Column:
    return F.when(F.col(matched_col).isNull(), F.lit("Not Included")).otherwise(F.lit("Coverage File Stores"))
