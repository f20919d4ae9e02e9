"""Feed ETL, coverage file and data-quality queries (retail model load)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import feeds_etl as FE
from ..operators import quality as Q
from ..sources import params as P
from ..sources import retail as R
from ..sources.tables import Tables
from .registry import ORACLE, query

SALES_FLOOR = _dt.date(1996, 1, 1)
# The retailer left out of the retailer order table (its rows keep no order).
EXCLUDED_RETAILERS = ("MIDDLE EAST",)
FIRST_SMM = ("AMERICA", "EUROPE")
SECOND_SMM = ("ASIA",)

_EXCL_SQL = ", ".join(f"'{r}'" for r in EXCLUDED_RETAILERS)
_RO_SQL = (f"ro AS (SELECT r_name AS retailer, CAST(r_regionkey + 1 AS BIGINT) AS retailer_order "
           f"FROM region WHERE r_name NOT IN ({_EXCL_SQL}))")


# ------------------------------------------------------------ feed union

@query("feed_union")
def feed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feeds in one scan (each line tagged with its feed), rows with a
    product and a date on/after the floor, with the retailer order and the
    join key; summarised per feed.  The date floor is a line filter, the
    product one a semi join; everything else depends on the store, so lines
    are pre-aggregated to it before the dimension and key are attached."""
    t = Tables(spark, sf_dir)
    u = R.feed_lines(t).where(F.col("sale_date") >= F.lit(SALES_FLOOR))
    u = u.join(R.product_dim(t).where(F.col("product").isNotNull()), "part_key", "left_semi")
    pre = u.groupBy("feed", "store_text").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("inserted_date").isNull(), F.lit(1))).alias("n_noins"),
        F.sum("value").alias("v"))
    pre = R.attach_dims(pre.withColumn("store", X.feed_store_number(F.col("store_text")).cast("bigint")), t,
                        ["retailer"])
    # Retailer order: one row per region (five) -- bounded by construction.
    pre = pre.drop("retailer_order").join(F.broadcast(R.retailer_order(t, EXCLUDED_RETAILERS)), "retailer", "left")
    pre = FE.with_fact_join_key(pre)
    return pre.groupBy("feed").agg(
        F.sum("n").cast("long").alias("n_rows"),
        F.sum("n_noins").cast("long").alias("n_without_inserted_date"),
        F.sum("v").cast("double").alias("sales"),
        F.sum(F.when(F.col("join_key").isNull(), F.col("n")).otherwise(0)).cast("long").alias("n_null_key"),
        F.min("join_key").alias("min_key"), F.max("join_key").alias("max_key"))


ORACLE["feed_union"] = f"""WITH {_RO_SQL},
f AS (
  SELECT coalesce(l.l_returnflag, '?') || coalesce(l.l_linestatus, '?') AS feed, l.l_suppkey AS store,
         CAST(l.l_shipdate AS DATE) AS sale_date, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS value,
         CASE WHEN l.l_linestatus IS DISTINCT FROM 'O' THEN CAST(l.l_shipdate AS DATE) END AS inserted_date,
         upper(trim(p.p_brand)) AS product, r.r_name AS retailer
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
k AS (
  SELECT f.*, CASE WHEN store IS NULL THEN NULL
              ELSE TRY_CAST(CAST(store AS VARCHAR) || coalesce(CAST(ro.retailer_order AS VARCHAR), '') AS BIGINT) END AS join_key
  FROM f LEFT JOIN ro USING (retailer)
  WHERE product IS NOT NULL AND sale_date >= DATE '{SALES_FLOOR}')
SELECT feed, count(*) AS n_rows, count(*) FILTER (WHERE inserted_date IS NULL) AS n_without_inserted_date,
       CAST(sum(value) AS DOUBLE) AS sales, count(*) FILTER (WHERE join_key IS NULL) AS n_null_key,
       min(join_key) AS min_key, max(join_key) AS max_key
FROM k GROUP BY feed"""


# ------------------------------------------------------- coverage file

# Source column names of the coverage file -> library names.
COVERAGE_RENAMES = {"Master_Chain": "master_chain", "Store_Num": "store_num_text", "Store_Name": "store_name",
                    "SMM": "smm", "SSR": "ssr"}


def coverage_source(t: Tables) -> DataFrame:
    """The coverage file (stores with a non-negative balance), delivered
    with its own column names and renamed on load."""
    sd = R.store_dim(t).where(F.col("in_coverage"))
    raw = sd.select(F.col("retailer").alias("Master_Chain"), F.col("store").cast("string").alias("Store_Num"),
                    F.col("store_name").alias("Store_Name"), F.col("smm").alias("SMM"), F.col("ssr").alias("SSR"))
    return P.rename_columns(raw, COVERAGE_RENAMES)


def coverage_dim(t: Tables) -> DataFrame:
    """The coverage file cleaned and keyed like the fact, right-joined to the
    retailer order, with rows per key."""
    return FE.coverage_pipeline(coverage_source(t), R.retailer_order(t, EXCLUDED_RETAILERS),
                                FIRST_SMM, SECOND_SMM)


@query("coverage_dim")
def coverage_dim_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coverage file cleaned and keyed like the fact, right-joined to
    the retailer order, with rows per key."""
    c = coverage_dim(Tables(spark, sf_dir))
    return c.select("chain", "store_num", "store_name", "smm", "ssr", "smm_sort", "smm_territory",
                    "retailer_order", "join_key", "occurrence")


_COV_SQL = f"""{_RO_SQL},
cs AS (
  SELECT r.r_name AS master_chain, CAST(s.s_suppkey AS VARCHAR) AS store_num_text, s.s_name AS store_name,
         r.r_name AS smm, n.n_name AS ssr
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE s.s_acctbal >= 0),
cj AS (
  SELECT coalesce(cs.master_chain, ro.retailer) AS chain, cs.store_num_text AS store_num, cs.store_name, cs.smm, cs.ssr,
         CAST(CASE WHEN cs.smm IN ('AMERICA', 'EUROPE') THEN 1 WHEN cs.smm IN ('ASIA') THEN 2 END AS INTEGER) AS smm_sort,
         CASE WHEN cs.smm IS NULL THEN NULL WHEN strpos(cs.smm, 'Cov') > 0 THEN cs.smm ELSE 'Covered' END AS smm_territory,
         ro.retailer_order,
         CASE WHEN cs.store_num_text IS NULL THEN NULL
              ELSE TRY_CAST(cs.store_num_text || CAST(ro.retailer_order AS VARCHAR) AS BIGINT) END AS join_key
  FROM cs RIGHT JOIN ro ON cs.master_chain = ro.retailer),
occ AS (SELECT join_key, count(*) AS occurrence FROM cj WHERE join_key IS NOT NULL GROUP BY join_key)"""

ORACLE["coverage_dim"] = f"""WITH {_COV_SQL}
SELECT cj.*, CAST(occ.occurrence AS BIGINT) AS occurrence FROM cj LEFT JOIN occ USING (join_key)"""


@query("coverage_flag")
def coverage_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows and sales per retailer, split by whether the fact's join
    key is present in the coverage file."""
    t = Tables(spark, sf_dir)
    per_store = R.sales_lines(t).groupBy("store").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    f = R.attach_dims(per_store, t, ["retailer"]).drop("retailer_order")
    f = f.join(F.broadcast(R.retailer_order(t, EXCLUDED_RETAILERS)), "retailer", "left")   # five rows
    f = FE.with_fact_join_key(f.withColumn("store_text", F.col("store").cast("string")))
    keys = coverage_dim(t).where(F.col("join_key").isNotNull()).select(
        "join_key", F.col("join_key").alias("matched")).distinct()
    f = f.join(keys, "join_key", "left").withColumn("coverage", Q.coverage_flag("join_key", "matched"))
    return f.groupBy("retailer", "coverage").agg(F.sum("n").cast("long").alias("n_rows"),
                                                 F.sum("v").cast("double").alias("sales"))


ORACLE["coverage_flag"] = f"""WITH {_COV_SQL},
f AS (
  SELECT r.r_name AS retailer, l.l_suppkey AS store, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS value
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
fk AS (
  SELECT f.*, CASE WHEN store IS NULL THEN NULL
              ELSE TRY_CAST(CAST(store AS VARCHAR) || coalesce(CAST(ro.retailer_order AS VARCHAR), '') AS BIGINT) END AS join_key
  FROM f LEFT JOIN ro USING (retailer)),
keys AS (SELECT DISTINCT join_key FROM cj WHERE join_key IS NOT NULL)
SELECT retailer, CASE WHEN keys.join_key IS NULL THEN 'Not Included' ELSE 'Coverage File Stores' END AS coverage,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(value) AS DOUBLE) AS sales
FROM fk LEFT JOIN keys ON fk.join_key = keys.join_key GROUP BY 1, 2"""


@query("key_quality")
def key_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key checks of the coverage dimension: rows, NULL keys, duplicated keys,
    largest occurrence."""
    return Q.key_checks(coverage_dim(Tables(spark, sf_dir)), "join_key")


ORACLE["key_quality"] = f"""WITH {_COV_SQL},
pk AS (SELECT join_key, count(*) AS c FROM cj GROUP BY join_key)
SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(coalesce(sum(c) FILTER (WHERE join_key IS NULL), 0) AS BIGINT) AS null_keys,
       CAST(count(*) FILTER (WHERE join_key IS NOT NULL AND c > 1) AS BIGINT) AS dup_keys,
       CAST(max(c) FILTER (WHERE join_key IS NOT NULL) AS BIGINT) AS max_occurrence FROM pk"""


# ------------------------------------------------- type-mismatch quarantine

# Declared types of the landed (all-string) order extract.
ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "decimal(7,2)",
               "o_orderdate": "date", "o_orderpriority": "string"}


def order_extract_strings(t: Tables) -> DataFrame:
    """Orders as an all-string landing table (like a spreadsheet load)."""
    o = t.orders
    return o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"),
                    F.col("o_custkey").cast("string").alias("o_custkey"),
                    F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
                    F.col("o_orderpriority").cast("string").alias("o_orderpriority"))


@query("type_error_quarantine")
def type_error_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows with a cell that does not convert to its declared type,
    numbered by position in the table."""
    raw = order_extract_strings(Tables(spark, sf_dir))
    raw = raw.withColumn("o_orderkey_n", F.col("o_orderkey").try_cast("bigint"))
    q = Q.type_mismatch_quarantine(raw, ORDER_TYPES, ["o_orderkey_n", *ORDER_TYPES])
    return q.select("row_no", "o_orderkey", "o_totalprice", "bad_columns")


ORACLE["type_error_quarantine"] = """WITH raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders),
numbered AS (SELECT *, CAST(row_number() OVER (ORDER BY TRY_CAST(o_orderkey AS BIGINT) NULLS LAST, o_orderkey NULLS LAST, o_custkey NULLS LAST,
                    o_totalprice NULLS LAST, o_orderdate NULLS LAST, o_orderpriority NULLS LAST) AS BIGINT) AS row_no FROM raw),
bad AS (
  SELECT *, concat_ws(',',
           CASE WHEN o_orderkey IS NOT NULL AND TRY_CAST(o_orderkey AS BIGINT) IS NULL THEN 'o_orderkey' END,
           CASE WHEN o_custkey IS NOT NULL AND TRY_CAST(o_custkey AS BIGINT) IS NULL THEN 'o_custkey' END,
           CASE WHEN o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL THEN 'o_totalprice' END,
           CASE WHEN o_orderdate IS NOT NULL AND TRY_CAST(o_orderdate AS DATE) IS NULL THEN 'o_orderdate' END) AS bad_columns
  FROM numbered)
SELECT row_no, o_orderkey, o_totalprice, bad_columns FROM bad WHERE bad_columns <> ''"""
