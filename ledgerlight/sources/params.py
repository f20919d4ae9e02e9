"""Parameter tables and small table helpers of the report model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def number_series(spark: SparkSession, start: int, stop: int, step: int = 1, name: str = "value") -> DataFrame:
    """GENERATESERIES(start, stop, step): inclusive integer series."""
    return spark.range(start, stop + 1, step).select(F.col("id").alias(name))


def with_refresh_time(df: DataFrame, name: str = "refreshed_at") -> DataFrame:
    """Stamp the load time (non-deterministic: not used in compared queries)."""
    return df.withColumn(name, F.current_timestamp())


def rename_columns(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename by a source -> target map; unknown source names are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def primitive_columns(df: DataFrame) -> DataFrame:
    """Keep only columns of atomic types (drop arrays, maps, structs)."""
    keep = [f.name for f in df.schema.fields
            if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    return df.select(*keep)


def map_columns_except(df: DataFrame, fn, except_cols=()) -> DataFrame:
    """Apply a column transform to every column but the listed ones."""
    return df.select(*[F.col(c) if c in except_cols else fn(F.col(c)).alias(c) for c in df.columns])


def page_of(df: DataFrame, order_cols, limit: int, offset: int = 0) -> DataFrame:
    """One page of an ordered result (only for when a page is wanted)."""
    out = df.orderBy(*order_cols)
    if offset:
        out = out.offset(offset)
    return out.limit(limit)


def in_set(df: DataFrame, col: str, members: DataFrame, member_col: str, negate: bool = False) -> DataFrame:
    """Rows whose ``col`` is (not) in a set held as a DataFrame: a semi (or
    anti) join, so the set can be any size.  NULL never matches (and is
    dropped by the NOT IN form too, as with SQL NOT IN over a NULL-free
    set plus a not-null test)."""
    s = members.select(F.col(member_col).alias("_member")).where(F.col("_member").isNotNull())
    j = df.join(s, df[col] == s["_member"], "left_anti" if negate else "left_semi")
    return j.where(F.col(col).isNotNull()) if negate else j


def axis_with_others(members: DataFrame, col: str, others: str = "Others") -> DataFrame:
    """Distinct members of ``col`` (the blank member included) plus one
    pooled 'Others' member."""
    spark = members.sparkSession
    extra = spark.createDataFrame([(others,)], f"{col} string")
    return members.select(F.col(col).cast("string").alias(col)).distinct().unionByName(extra)


# The column-selector remap (1 -> 10, 2 -> 1, n -> n - 1 for
# 3..11), the net effect of the selector's chained replacements.
def cascade_remap(c: Column) -> Column:
    return (F.when(c == 1, F.lit(10)).when(c == 2, F.lit(1))
             .when(c.between(3, 11), c - 1).otherwise(c)).cast("int")


def contains_category(c: Column, pairs, default=None) -> Column:
    """First (substring, category) pair whose substring occurs in ``c``."""
    expr = None
    for needle, cat in pairs:
        cond = F.instr(c, needle) > 0
        expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def check_group_cols(cols, allowed) -> list:
    """Validate a dynamic grouping choice against the allowed columns."""
    bad = [c for c in cols if c not in allowed]
    if bad:
        raise ValueError(f"unknown grouping column(s) {bad}; allowed: {sorted(allowed)}")
    return list(cols)
