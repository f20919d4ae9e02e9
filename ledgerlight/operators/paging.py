"""Pages of an ordered listing, found by seek.

The listing is ordered once: rows are ranged and sorted, every range is written by
itself with each row's place in it, and the directory keeps how many rows come before
a range.  A page then reads the one or two ranges that it lies in, whatever its offset:
nothing is sorted or skipped again.  The directory has a row a range.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


@dataclass(frozen=True)
class Paged:
    """A listing in ranges."""
    spark: SparkSession
    path: str
    schema: str
    columns: tuple[str, ...]
    ranges: tuple[int, ...]              # in the listing's order
    before: tuple[int, ...]              # rows before each range, and of all

    @property
    def total(self) -> int:
        return self.before[-1]

    def ranges_of(self, limit: int, offset: int) -> list[int]:
        """The ranges that hold rows ``offset`` to ``offset + limit``."""
        end = min(offset + limit, self.total)
        if limit <= 0 or offset >= end:
            return []
        first, last = bisect_right(self.before, offset) - 1, bisect_right(self.before, end - 1) - 1
        return [self.ranges[i] for i in range(first, last + 1) if self.before[i] < self.before[i + 1]]

    def page(self, limit: int, offset: int = 0, at: str | None = None) -> DataFrame:
        """One page; with ``at``, each row's place in the listing (from 0) as that column."""
        keep = [*self.columns, *([F.col("_place").alias(at)] if at else [])]
        parts = []
        for r in self.ranges_of(limit, offset):
            first = self.before[self.ranges.index(r)]
            rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/_range={r}").withColumn("_place", F.col("_at") + first)
            parts.append(rows.where(F.col("_at").between(offset - first, offset + limit - 1 - first)))
        if not parts:
            empty = self.spark.createDataFrame([], self.schema)
            return empty.withColumn("_place", F.col("_at")).select(*keep)
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.orderBy("_place").select(*keep)       # a page's rows


def write_paged(df: DataFrame, order, path: str | None = None) -> Paged:
    """``df`` in the order of ``order`` (columns that together name a row)."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "paged")
    row = F.monotonically_increasing_id()
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_range", F.shiftright(row, 33).cast("int")).withColumn("_at", row.bitwiseAND(F.lit((1 << 33) - 1))))
    placed.write.mode("error").partitionBy("_range").parquet(path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema if f.name != "_range")
    sizes = (spark.read.schema(f"{schema}, _range int").parquet(path).groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
             .orderBy("_range").collect())                     # one row a range
    before = [0]
    for r in sizes:
        before.append(before[-1] + r["n"])
    return Paged(spark, path, schema, tuple(df.columns), tuple(r["_range"] for r in sizes), tuple(before))
