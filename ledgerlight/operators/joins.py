"""Join helpers with a size check before any broadcast.

``broadcast()`` overrides Spark's own size estimate, so the hint is only
applied when the small side is proven small: with ``max_rows=n`` a bounded
count (``limit(n + 1).count()``) shows at most n rows.  Worth it only for
plain scans, where the count stops early; for a derived (aggregated) side it
would compute the side twice.

Every other dimension join carries no hint: the planner broadcasts it when
its statistics are under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
converts a sort-merge join to a broadcast join at runtime once the
materialised side is known to be small.  Past those bounds it stays a
shuffle join, so nothing large is ever shipped to every executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """Bounded size check, made anew for every plan: reads at most
    ``max_rows + 1`` rows per task."""
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    if max_rows is not None and has_at_most(df, max_rows):
        return F.broadcast(df)
    return df


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "left",
             max_rows: int | None = None) -> DataFrame:
    """Many-to-one join of a fact to a dimension (left by default, so fact
    rows without a dimension match keep a blank member)."""
    return fact.join(maybe_broadcast(dim, max_rows), on, how)


def first_per_key(df: DataFrame, keys, order_cols, latest: bool = False) -> DataFrame:
    """One row per key: the row with the smallest (or, with ``latest``, the
    largest) ``order_cols`` tuple; remaining columns ride along.

    Written as ``min``/``max`` of a struct, i.e. an aggregate with a
    map-side partial step, so a key holding a third of all rows is
    collapsed inside every map task before the shuffle (a per-key window
    sort would send the whole hot key to one task).
    """
    keys = list(keys)
    order_cols = list(order_cols)
    payload = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + payload])
    agg = (F.max if latest else F.min)(packed).alias("_pick")
    return df.groupBy(*keys).agg(agg).select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in order_cols + payload])
