"""Exact distinct counts that can be merged.

A set of integer keys is kept as bitmaps: a key has a bucket and a bit in it
(32,768 keys a bucket), and a group keeps one bitmap for each bucket that
it has keys in.  Bitmaps of the finest groups are built once; any coarser group is the
OR of its parts, whether or not they share keys, so the counts of all levels and
windows come from one pass over the fact and one over the bitmaps, with no
distinct rows shuffled a level.

A bitmap has a fixed size (4 KB), so what travels grows with groups and
buckets, never with lines.  BLANK counts as one member of a group: it has no bit
but a flag, which is merged by maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grouping import grouped_by_sets

BUCKET = "_bucket"


def key_bitmaps(rows: DataFrame, key: str, groups, present: dict[str, Column]) -> DataFrame:
    """One row per ``groups`` and bucket: for every name of ``present`` (a
    condition on ``rows``) the bitmap of the keys that meet it, ``name``, and
    whether the blank key does, ``name__blank``.  Rows of the blank key are in
    the bucket of key 0."""
    groups = list(groups)
    bit = F.bitmap_bit_position(F.col(key))
    aggs = []
    for name, cond in present.items():
        aggs.append(F.bitmap_construct_agg(F.when(cond & F.col(key).isNotNull(), bit)).alias(name))
        aggs.append(F.max(F.when(cond & F.col(key).isNull(), 1).otherwise(0)).alias(f"{name}__blank"))
    bucket = F.bitmap_bucket_number(F.coalesce(F.col(key), F.lit(0).cast("long")))
    return rows.groupBy(*groups, bucket.alias(BUCKET)).agg(*aggs)


def merged(bitmaps: DataFrame, sets, names, level: str = "level") -> DataFrame:
    """The bitmaps of every grouping set in ``sets`` (lists of columns, the first
    being number 0), OR-ed; ``level`` is the set's number.  A column that a set
    leaves out is NULL."""
    aggs = [a for n in names for a in (F.bitmap_or_agg(n).alias(n), F.max(f"{n}__blank").alias(f"{n}__blank"))]
    return grouped_by_sets(bitmaps, sets, aggs, always=(BUCKET,), level=level)


def counts(bitmaps: DataFrame, groups, names) -> DataFrame:
    """Distinct keys of every group, BLANK as one of them: the sum of the buckets' bits."""
    return bitmaps.groupBy(*groups).agg(*[(F.sum(F.bitmap_count(n)) + F.max(f"{n}__blank")).cast("long").alias(n) for n in names])
