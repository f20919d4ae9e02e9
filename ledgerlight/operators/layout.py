"""A layout that serves filters on several columns: rows clustered along a Z-order curve.

Sorting by date alone lets a scan skip files by date only.  Here the bits of several
columns are interleaved into one key, the highest bits first, and rows are ranged by
it: each file then covers a short interval of *every* column, so the minima and
maxima in the file footers cut on each of them, alone or together.

The columns are first cut to ``bits`` bits by their place among sampled quantiles
(equal shares of rows, so a hot or skewed column uses all its bits).  Ranges are
sampled by Spark and rows of one key are spread by a further key, so a store
with a third of all lines is many files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 8


def interleaved(places, bits: int = BITS) -> Column:
    """The bits of the columns ``places`` (each 0 to 2 ** bits - 1) in turn, highest first."""
    places = list(places)
    if bits * len(places) > 62:
        raise ValueError("too many bits for a long")
    key = F.lit(0).cast("long")
    for b in range(bits):
        for i, p in enumerate(places):
            at = b * len(places) + (len(places) - 1 - i)
            key = key.bitwiseOR(F.shiftleft(F.shiftright(p.cast("long"), b).bitwiseAND(F.lit(1).cast("long")), at))
    return key


def place_among(column: str, cuts) -> Column:
    """How many of the ascending ``cuts`` the column exceeds, by halving; NULL is 0."""
    def within(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(column) > F.lit(cuts[mid]), within(mid + 1, hi)).otherwise(within(lo, mid))
    return F.coalesce(within(0, len(cuts)), F.lit(0))


def quantiles(df: DataFrame, columns, bits: int = BITS) -> dict[str, list[float]]:
    """2 ** bits - 1 cuts of equal shares for every column, as numbers; one aggregate."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(F.col(c), F.array(*[F.lit(s) for s in shares]), F.lit(2000)).alias(c) for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def write_clustered(df: DataFrame, columns, path: str, files: int, bits: int = 5) -> None:
    """``df`` in about ``files`` files that are each narrow in all ``columns`` (numbers or dates)."""
    number = {c: F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) if t == "date" else F.col(c) for c, t in df.dtypes if c in columns}
    marked = df.select("*", *[number[c].alias(f"_n_{c}") for c in columns])
    cuts = quantiles(marked, [f"_n_{c}" for c in columns], bits)
    key = interleaved([place_among(f"_n_{c}", cuts[f"_n_{c}"]) for c in columns], bits)
    ranged = marked.withColumn("_z", key).withColumn("_salt", F.xxhash64(*df.columns)).repartitionByRange(files, "_z", "_salt")
    ranged.sortWithinPartitions("_z").select(*df.columns).write.mode("error").parquet(path)
