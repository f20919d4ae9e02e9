"""Writers.  A table version is always written to a new folder (a path is
never overwritten while a plan may still read it); callers swap the
pointer (or the catalog entry) once the write succeeded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def write_version(df: DataFrame, spark: SparkSession, name: str, partition_by=(), fmt: str = "parquet") -> str:
    """Write ``df`` as a new version under the shared checkpoint folder and
    return its path (also the way to cut a long lineage)."""
    path = scratch_path(spark, name)
    w = df.write.mode("error").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def append_evolving(df: DataFrame, path: str) -> None:
    """Append with schema evolution (new columns are added on read by
    ``mergeSchema``)."""
    df.write.mode("append").option("mergeSchema", "true").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def overwrite_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def table_or_default(spark: SparkSession, name: str, default: DataFrame) -> DataFrame:
    """The named table; when it does not exist it is created from
    ``default`` first."""
    if not spark.catalog.tableExists(name):
        default.write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


def write_payloads(inserts: DataFrame, updates: DataFrame, spark: SparkSession, name: str = "visit-payloads") -> str:
    """The outbound insert and update sets, one folder per method."""
    path = scratch_path(spark, name)
    inserts.write.mode("error").parquet(f"{path}/method=insert")
    updates.write.mode("error").parquet(f"{path}/method=update")
    return path


def write_bucketed(df: DataFrame, name: str, keys, buckets: int, sort: bool = True) -> None:
    """Save ``df`` as a catalog table bucketed (and sorted) by ``keys``.

    Tables joined on the same keys with the same bucket count are joined
    bucket by bucket: neither side is shuffled.  Suits the tables the sync
    joins on every run (the outcome log and the pushed-visit history on the
    visit key)."""
    keys = list(keys)
    w = df.write.mode("overwrite").bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(name)
