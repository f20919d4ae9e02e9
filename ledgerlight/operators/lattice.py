"""Sums by many grouping sets, written once, and read from the smallest that will do.

A report removes filters at will: by store, by product, by retailer, or all of
them.  ``build`` computes the measures of a family of grouping sets in one scan
and one aggregate and writes each set by itself.  A question by some columns is answered
from the set with the fewest rows that has them all (``Lattice.covering``): exactly
that set needs no further sum, any other is summed up, as sums may be.  Removing a
filter is asking by fewer columns (``toggle``), so no toggle goes back to the fact.

A set's rows are bounded by its members, not by the fact's lines; with a store and a
product in two different sets, the product of both is never written.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import DateRange, envelope
from ..session import scratch_path
from ..sources import retail as R
from ..sources.tables import Tables
from .grouping import grouped_by_sets
from .measures import _cond_sums


@dataclass(frozen=True)
class Lattice:
    spark: SparkSession
    path: str
    schema: str                          # of every set's folder
    sets: tuple[tuple[str, ...], ...]
    rows: tuple[int, ...]                # of each set
    measures: tuple[str, ...]

    def covering(self, by) -> int:
        """The number of the smallest set that has all columns of ``by``."""
        fit = [(self.rows[i], len(s), i) for i, s in enumerate(self.sets) if set(by) <= set(s)]
        if not fit:
            raise LookupError(f"no set has all of {sorted(by)}")
        return min(fit)[2]

    def read(self, number: int) -> DataFrame:
        every = self.spark.read.schema(self.schema).parquet(f"{self.path}/_set={number}")
        return every.select(*self.sets[number], *self.measures)

    def answer(self, by) -> DataFrame:
        """The measures by the columns ``by``."""
        by = list(by)
        number = self.covering(by)
        found = self.read(number)
        if set(by) == set(self.sets[number]):
            return found.select(*by, *self.measures)
        return found.groupBy(*by).agg(*[F.sum(m).alias(m) for m in self.measures])

    def toggle(self, by, removed) -> DataFrame:
        """The measures by ``by`` and, as ``<measure>_all``, with the filter on the
        columns ``removed`` taken away; blank members meet their blank totals."""
        by, kept = list(by), [c for c in by if c not in set(removed)]
        own, total = self.answer(by), self.answer(kept)
        if not kept:
            # One total: a single row, as constants.
            one = total.first()
            kinds = dict(total.dtypes)
            return own.select(*by, *self.measures, *[F.lit(one[m] if one else None).cast(kinds[m]).alias(f"{m}_all") for m in self.measures])
        total = total.select(*[F.col(c).alias(f"_k_{c}") for c in kept], *[F.col(m).alias(f"{m}_all") for m in self.measures])
        on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in kept])
        joined = own.join(total, on, "left")
        return joined.select(*by, *self.measures, *[f"{m}_all" for m in self.measures])


def build(t: Tables, windows: dict[str, DateRange], sets, path: str | None = None) -> Lattice:
    """The sums of ``windows`` by every set of store and product columns in ``sets``."""
    sets = tuple(tuple(s) for s in sets)
    used = {c for s in sets for c in s}
    lines = R.attach_dims(R.sales_lines(t, envelope(windows.values())), t, used & set(R.PRODUCT_ATTRS))
    pre = lines.groupBy("store", *sorted(used & set(R.PRODUCT_ATTRS))).agg(*_cond_sums(windows))
    fact = R.attach_dims(pre, t, used & set(R.STORE_ATTRS))
    sums = grouped_by_sets(fact, sets, [F.sum(n).alias(n) for n in windows], level="_set")
    path = path or scratch_path(t.spark, "lattice")
    sums.write.mode("error").partitionBy("_set").parquet(path)
    kept = [f for f in sums.schema if f.name != "_set"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    # One row a set.
    counted = {r["_set"]: r["n"] for r in t.spark.read.schema(f"{schema}, _set int").parquet(path).groupBy("_set").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = tuple(counted.get(i, 0) for i in range(len(sets)))
    for i in range(len(sets)):
        if not rows[i]:                  # no line at all: an empty set has no folder
            t.spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/_set={i}")
    return Lattice(t.spark, path, schema, sets, rows, tuple(windows))
