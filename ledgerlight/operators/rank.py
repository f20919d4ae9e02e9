"""Ranking operators.

Global ranks (over every row, no partition key) are computed without a
single-partition window: the distinct values are range-partitioned by the
ranking value, each range is ranked locally, and per-range offsets (one row
per range, so bounded by the partition count) are added back.  This is
the DataFrame form of a distributed sort-and-number and holds however many
rows are ranked.

The input is evaluated once: it is materialised with a reliable
``checkpoint()`` in the shared checkpoint folder, and so are the sorted
ranges, whose bounds come from sampling and must be the same for all their
consumers (a lost executor re-reads them instead of re-sampling).  A
range's row positions come from ``monotonically_increasing_id`` on the
sorted, materialised partitions, so nothing is shuffled a second time.

Ranks inside a group (``partition_by``) and over a code-table level use an
ordinary window; callers only use those on already-aggregated rows (one
per member), where a group is bounded by the dimension's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(col: str, ascending: bool):
    return F.col(col).asc() if ascending else F.col(col).desc()


def materialised(df: DataFrame) -> DataFrame:
    """``df`` evaluated once, into the shared checkpoint folder."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _positions(ranged: DataFrame, weight: str | None = None) -> DataFrame:
    """Materialised, range-partitioned and sorted rows with ``_at`` (position
    in the whole, from 0) and, with ``weight``, ``_before`` (its sum over all
    earlier ranges)."""
    row = F.monotonically_increasing_id()
    ided = ranged.withColumn("_pid", F.shiftright(row, 33)).withColumn("_in", row.bitwiseAND(F.lit((1 << 33) - 1)))
    per_part = ided.groupBy("_pid").agg(F.count(F.lit(1)).alias("_rows"), F.sum(weight or F.lit(1)).alias("_w"))
    # One row per range partition, so a single explicit group is bounded.
    earlier = Window.partitionBy(F.lit(0)).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_pid", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_off"),
                              F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_before"))
    return ided.join(F.broadcast(offsets), "_pid").withColumn("_at", F.col("_off") + F.col("_in")).drop("_off", "_in")


def global_row_number(df: DataFrame, order_cols, out_col: str = "row_no") -> DataFrame:
    """Number all rows from 1 in the order of ``order_cols`` (NULLs last).
    Rows alike in all of them are spread by a random last key, so a key that
    many rows share does not end up in one range."""
    order = [F.col(c).asc_nulls_last() for c in order_cols] + [F.col("_salt").asc()]
    salted = df.withColumn("_salt", F.rand(11))
    ranged = materialised(salted.repartitionByRange(*order).sortWithinPartitions(*order))
    return _positions(ranged).withColumn(out_col, (F.col("_at") + 1).cast("long")).select(*df.columns, out_col)


def global_rank(df: DataFrame, value_col: str, out_col: str = "rank", method: str = "dense",
                ascending: bool = False, partitions: int | None = None, once: bool = False) -> DataFrame:
    """Rank every row of ``df`` by ``value_col``.

    method: 'dense' (1,2,2,3) or 'skip' (1,2,2,4).  Rows whose value is NULL
    get a NULL rank (a blank measure is not ranked).  ``df`` is used twice
    and so materialised first; ``once`` says that it already is.
    """
    if method not in ("dense", "skip"):
        raise ValueError(method)
    if not once:
        df = materialised(df)
    vals = (df.where(F.col(value_col).isNotNull())
              .groupBy(value_col).agg(F.count(F.lit(1)).alias("_n")))
    order = _order(value_col, ascending)
    # Without an explicit count AQE may merge small adjacent ranges (merging
    # keeps their order, which is all the offsets need).
    parted = vals.repartitionByRange(partitions, order) if partitions else vals.repartitionByRange(order)
    placed = _positions(materialised(parted.sortWithinPartitions(order)), "_n")
    if method == "dense":
        r = F.col("_at") + 1
    else:
        local = Window.partitionBy("_pid").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        r = F.lit(1) + F.col("_before") + F.coalesce(F.sum("_n").over(local), F.lit(0))
    ranks = placed.select(value_col, r.cast("long").alias(out_col))
    return df.join(ranks, value_col, "left").select(*df.columns, out_col)


def level_rank(df: DataFrame, value_col: str, out_col: str, method: str = "dense", rank_blank: bool = False) -> DataFrame:
    """Descending rank over all rows of a code-table level (one row per
    retailer, SMM or SSR: a few dozen). ``rank_blank`` also ranks blank
    values, last."""
    w = Window.partitionBy(F.lit(0)).orderBy(F.col(value_col).desc_nulls_last())
    rank = (F.dense_rank() if method == "dense" else F.rank()).over(w).cast("long")
    return df.withColumn(out_col, rank if rank_blank else F.when(F.col(value_col).isNotNull(), rank))


def group_rank(df: DataFrame, partition_by, value_col: str, out_col: str = "rank", method: str = "skip",
               ascending: bool = False) -> DataFrame:
    """Rank inside each group (rows are already one per member)."""
    w = Window.partitionBy(*partition_by).orderBy(_order(value_col, ascending))
    fn = F.dense_rank() if method == "dense" else F.rank()
    return df.withColumn(out_col, F.when(F.col(value_col).isNotNull(), fn.over(w)).cast("long"))


def member_at_rank(ranked: DataFrame, partition_by, rank_col: str, member_col: str, ks) -> DataFrame:
    """For each group and each k in ``ks``: the member holding rank k, or
    NULL when no member or more than one (a tie) holds it.  Groups meet by
    grouping, not by joining, so a blank group keeps its holders."""
    partition_by = list(partition_by)
    ks = [F.lit(int(k)).cast("long") for k in ks]
    member = ranked.schema[member_col].dataType
    hits = (ranked.where(F.col(rank_col).isin(*ks))
                  .select(*partition_by, F.col(rank_col).alias("k"), F.lit(1).alias("_c"), F.col(member_col).alias("_m")))
    grid = (ranked.select(*partition_by).distinct()
                  .select(*partition_by, F.explode(F.array(*ks)).alias("k"), F.lit(0).alias("_c"), F.lit(None).cast(member).alias("_m")))
    out = hits.unionByName(grid).groupBy(*partition_by, "k").agg(F.sum("_c").alias("_c"), F.min("_m").alias("_m"))
    return out.select(*partition_by, "k", F.when(F.col("_c") == 1, F.col("_m")).alias(f"{member_col}_at_k"))


def rank_flags(ranked: DataFrame, rank_col: str, ks) -> DataFrame:
    """``ranked`` with one column per k: 1 for the member that holds rank k,
    else blank."""
    return ranked.withColumns({f"is_rank_{k}": F.when(F.col(rank_col) == k, F.lit(1)) for k in ks})
