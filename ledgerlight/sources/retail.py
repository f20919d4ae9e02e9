"""Retail star schema on the driver tables.

Mapping (fixed for the whole library):

  POS fact      lineitem:  part_key = l_partkey, store = l_suppkey,
                sale_date = date(l_shipdate), value = l_extendedprice as
                decimal(18,2)
  product dim   part:      product = upper(trim(p_brand))
  store dim     supplier ⋈ nation ⋈ region: retailer (chain) = r_name,
                retailer_order = r_regionkey + 1, smm = r_name,
                ssr = ssr_name = n_name, smm_territory from smm,
                store_name = s_name; a store is in the
                coverage file when s_acctbal >= 0
  category fact orders ⋈ customer: category = c_mktsegment,
                store = o_custkey, value = o_totalprice, date = o_orderdate
  feeds         the POS lines tagged by (l_returnflag, l_linestatus), '?'
                for a missing code; feeds with l_linestatus = 'O' carry no
                inserted date

Region and nation are fixed-size code tables (5 and 25 rows), so they are
broadcast without a check; supplier, part and customer grow with the data,
so their joins carry no hint and the planner / AQE decide from statistics.

For large histories ``write_fact_by_month`` lays the POS lines out by sale
month; a ``Tables`` with ``fact_path`` set reads them from there and every
window query then prunes whole month directories (partition filters) on
top of the row-group skipping of the pushed date filter.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.blanks import money
from ..functions.calendar import DateRange
from ..operators.joins import join_dim
from .tables import Tables


def ts_bounds(col: str, r: DateRange):
    """Half-open timestamp predicate on a raw timestamp column equivalent to
    ``to_date(col) BETWEEN r.start AND r.end``; written on the raw column so
    the parquet reader gets it as a pushed filter."""
    if r is None:
        return F.lit(True)
    if r.empty:
        return F.lit(False)
    # Literals built from text: independent of the driver's and the
    # session's time zone (the columns are wall-clock timestamps).
    lo = F.lit(f"{r.start.isoformat()} 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{(r.end + _dt.timedelta(days=1)).isoformat()} 00:00:00").cast("timestamp_ntz")
    c = F.col(col)
    return (c >= lo) & (c < hi)


def sales_lines(t: Tables, dates: DateRange | None = None) -> DataFrame:
    """POS fact lines at their natural grain."""
    fact_path = getattr(t, "fact_path", None)
    if fact_path:
        return month_partitioned_lines(t.spark, fact_path, dates)
    li = t.lineitem.where(ts_bounds("l_shipdate", dates)) if dates is not None else t.lineitem
    return li.select(
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("store"),
        F.to_date("l_shipdate").alias("sale_date"),
        money(F.col("l_extendedprice")).alias("value"),
    )


def write_fact_by_month(t: Tables, path: str, partitions: int | None = None) -> str:
    """Write the POS lines partitioned by sale month.  Range partitioning on
    date, store and part gives each task a contiguous slice, so each task
    writes into few month folders and files stay large, and neither a month
    nor a peak day lands in a single task."""
    spark = t.spark
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = (t.lineitem.select(F.col("l_partkey").alias("part_key"), F.col("l_suppkey").alias("store"),
                               F.to_date("l_shipdate").alias("sale_date"),
                               money(F.col("l_extendedprice")).alias("value"))
             .withColumn("sale_month", F.date_format("sale_date", "yyyy-MM")))
    (lines.repartitionByRange(n, "sale_date", "store", "part_key").sortWithinPartitions("sale_date", "store")
          .write.mode("error").partitionBy("sale_month").parquet(path))
    return path


def month_partitioned_lines(spark: SparkSession, path: str, dates: DateRange | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if dates is not None:
        if dates.empty:
            df = df.where(F.lit(False))
        else:
            df = df.where(F.col("sale_month").between(dates.start.strftime("%Y-%m"), dates.end.strftime("%Y-%m"))
                          & F.col("sale_date").between(F.lit(dates.start), F.lit(dates.end)))
    return df.select("part_key", "store", "sale_date", "value")


class FactTables(Tables):
    """Driver tables whose POS lines come from a month-partitioned copy."""

    def __init__(self, spark: SparkSession, root: str, fact_path: str):
        super().__init__(spark, root)
        self.fact_path = fact_path


def region_dim(t: Tables) -> DataFrame:
    return t.region.select(
        F.col("r_regionkey").alias("region_key"),
        F.col("r_name").alias("retailer"),
        (F.col("r_regionkey") + 1).cast("long").alias("retailer_order"),
    )


def retailer_order(t: Tables, exclude=()) -> DataFrame:
    """Retailer -> display order (a code table; listed retailers removed)."""
    r = region_dim(t).select("retailer", "retailer_order")
    if exclude:
        r = r.where(~F.col("retailer").isin(list(exclude)))
    return r


def store_dim(t: Tables) -> DataFrame:
    """One row per store with its chain and territory hierarchy."""
    return t.memo("store_dim", lambda: _store_dim(t))


def _store_dim(t: Tables) -> DataFrame:
    nat = t.nation.select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("ssr"),
                          F.col("n_regionkey").alias("region_key"))
    geo = nat.join(F.broadcast(region_dim(t)), "region_key", "left")
    sup = t.supplier.select(
        F.col("s_suppkey").alias("store"),
        F.col("s_name").alias("store_name"),
        F.col("s_nationkey").alias("nation_key"),
        (F.col("s_acctbal") >= 0).alias("in_coverage"),
    )
    return (sup.join(F.broadcast(geo), "nation_key", "left")
               .select("store", "store_name", "retailer", "retailer_order",
                       F.col("retailer").alias("smm"), "ssr", "in_coverage",
                       F.when(F.instr("retailer", "Cov") > 0, F.col("retailer")).when(F.col("retailer").isNotNull(), "Covered")
                       .alias("smm_territory"), F.col("ssr").alias("ssr_name")))


def product_dim(t: Tables) -> DataFrame:
    return t.memo("product_dim", lambda: t.part.select(F.col("p_partkey").alias("part_key"),
                         F.upper(F.trim(F.col("p_brand"))).alias("product")))


STORE_ATTRS = ("store_name", "retailer", "retailer_order", "smm", "ssr", "in_coverage", "smm_territory", "ssr_name")
PRODUCT_ATTRS = ("product",)


def attach_dims(df: DataFrame, t: Tables, cols) -> DataFrame:
    """Left-join only the dimensions whose attributes are asked for."""
    cols = set(cols)
    if cols & set(STORE_ATTRS):
        df = join_dim(df, store_dim(t), "store")
    if cols & set(PRODUCT_ATTRS):
        df = join_dim(df, product_dim(t), "part_key")
    return df


def category_lines(t: Tables, dates: DateRange | None = None) -> DataFrame:
    """Category fact lines (orders) at their natural grain."""
    o = t.orders.where(ts_bounds("o_orderdate", dates)) if dates is not None else t.orders
    return o.select(F.col("o_custkey").alias("store"), F.to_date("o_orderdate").alias("sale_date"),
                    money(F.col("o_totalprice")).alias("value"))


def category_dim(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("store"), F.col("c_mktsegment").alias("category"))


def category_store_dim(t: Tables) -> DataFrame:
    """The category fact's stores (customers) with their retailer."""
    nat = t.nation.select(F.col("n_nationkey").alias("nation_key"), F.col("n_regionkey").alias("region_key"))
    geo = nat.join(F.broadcast(region_dim(t)), "region_key", "left").select("nation_key", "retailer")
    cust = t.customer.select(F.col("c_custkey").alias("store"), F.col("c_nationkey").alias("nation_key"))
    return cust.join(F.broadcast(geo), "nation_key", "left").select("store", "retailer")


def feed_lines(t: Tables) -> DataFrame:
    """The POS lines of every feed in one scan, each with the feed it came
    in (whatever codes there are; no line is left out). Rows of the open
    feeds have no inserted date."""
    code = lambda c: F.coalesce(F.col(c), F.lit("?"))
    shipped = F.to_date("l_shipdate")
    return t.lineitem.select(
        F.col("l_partkey").alias("part_key"), F.col("l_suppkey").cast("string").alias("store_text"),
        shipped.alias("sale_date"), money(F.col("l_extendedprice")).alias("value"),
        F.concat(code("l_returnflag"), code("l_linestatus")).alias("feed"),
        F.when(code("l_linestatus") != "O", shipped).alias("inserted_date"))


def week_windows(spark: SparkSession) -> DataFrame:
    """Week-window parameter table (weeks, sort, label); 9999 = YTD."""
    # Fixed values of the report's week selector.
    rows = [(1, 1, "1 Week"), (4, 2, "4 Weeks"), (13, 3, "13 Weeks"), (26, 4, "26 Weeks"),
            (52, 6, "52 Weeks"), (9999, 7, "YTD")]
    return spark.createDataFrame(rows, "weeks long, sort long, label string")
