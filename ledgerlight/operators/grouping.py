"""Several grouping sets in one aggregate, each row marked with its set's number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grouped_by_sets(df: DataFrame, sets, aggs, always=(), level: str = "level") -> DataFrame:
    """``aggs`` by every set of columns in ``sets`` (the first being number 0), each
    together with the columns ``always``.  A column that a set leaves out is NULL, which
    the set's number tells from a blank member."""
    every = list(dict.fromkeys(c for s in sets for c in s))
    grouped = df.groupingSets([[F.col(c) for c in (*s, *always)] for s in sets], *[F.col(c) for c in (*every, *always)])
    # grouping_id has a bit for each column, the first column's being the highest; ``always`` is in every set.
    bit = {c: 1 << (len(every) + len(always) - 1 - i) for i, c in enumerate(every)}
    number = [(sum(bit[c] for c in every if c not in s), k) for k, s in enumerate(sets)]
    name = F.element_at(F.create_map(*[x for g, k in number for x in (F.lit(g).cast("long"), F.lit(k).cast("int"))]), F.col("_gid"))
    out = grouped.agg(F.grouping_id(*every, *always).alias("_gid"), *aggs)
    return out.withColumn(level, name).drop("_gid")
