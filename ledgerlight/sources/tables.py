"""Readers for the driver's parquet tables.

Every reader returns a lazy DataFrame; Catalyst prunes the columns and
pushes the filters of whatever plan is built on top into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


class Tables:
    """Named access to the tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        """The table's DataFrame; one per name and instance, so a plan that
        uses a table several times lists and inspects its files once (and
        identical sub-plans can share an exchange)."""
        if name not in TABLES:
            raise KeyError(name)
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(self.path(name))
        return self._frames[name]

    def memo(self, key: str, build) -> DataFrame:
        """A derived frame built once per instance (same object on reuse)."""
        if key not in self._frames:
            self._frames[key] = build()
        return self._frames[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name == "fact_path":
            raise AttributeError(name)
        if name in TABLES:
            return self.read(name)
        raise AttributeError(name)


def register_views(spark: SparkSession, root: str, names=TABLES) -> None:
    """Register each table as a temp view (for SQL-API plans)."""
    t = Tables(spark, root)
    for n in names:
        t.read(n).createOrReplaceTempView(n)
