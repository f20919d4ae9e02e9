"""Retail calendar, aggregates, store-filter toggles, hierarchy rollup,
ranks, retailer comparisons and trend classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import blanks as B
from ..operators import calendar_dim as CD
from ..operators import measures as M
from ..functions import text as X
from ..operators.rank import global_rank, group_rank, level_rank, member_at_rank, rank_flags
from ..operators.report import pooled_member
from ..sources import retail as R
from ..sources.tables import Tables
from . import sqlkit as S
from .registry import ORACLE, query
from .retail import N_WEEKS, SEL, _anchor_cte, _with

PRODUCT = "BRAND#13"
RETAILER = "AMERICA"
CUSTOMERS = ("AMERICA", "EUROPE")
RANK_KS = (1, 2, 3, 4, 5, 6)
_NW = 7 * N_WEEKS - 1


def _fact_calendar(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The calendar over the fact's date span (one row per day) and its (lo, hi) bounds row."""
    li = t.lineitem
    bounds = li.agg(F.to_date(F.min("l_shipdate")).alias("lo"), F.to_date(F.max("l_shipdate")).alias("hi"))
    cal = CD.calendar_attributes(CD.calendar_from_bounds(bounds))
    return cal, bounds


# --------------------------------------------------------------- calendar

@query("calendar_dim")
def calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar dimension over the fact's date span with every label
    column."""
    cal, _ = _fact_calendar(Tables(spark, sf_dir))
    return CD.latest_month_label(cal).drop("last_date")


_DOW = S.dow("d")
ORACLE["calendar_dim"] = _with(S.calendar_cte(), """mx AS (SELECT max(d) AS last_date FROM cal)""") + f"""
SELECT d AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day, wk AS week,
       CAST(floor((dayofyear(d) + (dayofweek(make_date(year(d), 1, 1)) + 1) - 2) / 7) AS INTEGER) + 1 AS weeknum,
       strftime(d, '%A') AS weekday_name,
       CAST({_DOW} AS INTEGER) AS weekday_number, we AS week_ending,
       strftime(d, '%b') || ' ' || CAST(year(d) AS VARCHAR) AS month_year_label,
       CAST(year(d) * 10000 + month(d) * 100 AS INTEGER) AS date_key, strftime(d, '%B') AS month_name,
       CAST(quarter(d) AS INTEGER) AS quarter_no,
       CASE WHEN month(d) < 4 THEN 'QTR 1' WHEN month(d) < 7 THEN 'QTR 2' WHEN month(d) < 10 THEN 'QTR 3' ELSE 'QTR 4' END AS quarter,
       (year(d) % 4 = 0 AND (year(d) % 100 <> 0 OR year(d) % 400 = 0)) AS is_leap_year,
       'WK ' || CAST(wk AS VARCHAR) || ', ' || strftime(we, '%m-%d-%Y') AS week_label,
       CAST(wk AS VARCHAR) || ' Week' AS week_no_label,
       CASE WHEN year(d) = year(last_date) AND month(d) = month(last_date) THEN 'Latest '
            ELSE strftime(d, '%b') || ' ' || CAST(year(d) AS VARCHAR) END AS month_year,
       last_day(d) AS month_end
FROM cal, mx"""


@query("week_ending_carry")
def week_ending_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week-ending dates with the week-52 carry to the previous year's last
    week-52 day."""
    cal, _ = _fact_calendar(Tables(spark, sf_dir))
    return CD.week_ending_carry(cal).select("date", "week", "weekday_number", "week_ending_date")


ORACLE["week_ending_carry"] = _with(S.calendar_cte(), """w52 AS (
  SELECT y + 1 AS y, max(d) AS prev_w52 FROM cal WHERE wk = 52 GROUP BY y)""") + f"""
SELECT c.d AS date, c.wk AS week, CAST({S.dow('c.d')} AS INTEGER) AS weekday_number,
       CASE WHEN c.wk = 52 AND {S.dow('c.d')} <> 7 THEN w52.prev_w52 ELSE c.we END AS week_ending_date
FROM cal c LEFT JOIN w52 ON c.y = w52.y"""


# ---------------------------------------------------------- basic measures

@query("store_stats_by_retailer")
def store_stats_by_retailer(spark: SparkSession, sf_dir: str, product: str = PRODUCT,
                            sel: M.Selection = SEL) -> DataFrame:
    """Total sales, one product's sales, distinct stores and distinct store
    join keys (BLANK counted), first/last sale date over the whole history,
    and the store rows of the selected week."""
    t = Tables(spark, sf_dir)
    week = M.selected_week_window(sel)
    pre = (R.attach_dims(R.sales_lines(t), t, ["product"]).groupBy("store")
           .agg(F.sum("value").alias("total"), F.sum(F.when(F.col("product") == product, F.col("value"))).alias("of_product"),
                F.count(F.when(week.contains(F.col("sale_date")), F.col("store"))).alias("rows_week"),
                F.min("sale_date").alias("first_d"), F.max("sale_date").alias("last_d")))
    fact = R.attach_dims(pre, t, ["retailer"])
    fact = fact.withColumn("join_key", X.join_key(F.col("store").cast("string"), F.col("retailer_order")))
    # One row per store here, so a distinct count is a count.
    blank = lambda c: F.max(F.when(F.col(c).isNull(), F.lit(1)).otherwise(F.lit(0)))
    out = fact.groupBy("retailer").agg(
        F.sum("total").cast("double").alias("total_sales"),
        F.sum("of_product").cast("double").alias("product_sales"),
        (F.count("store") + blank("store")).cast("long").alias("store_count"),
        (F.count("join_key") + blank("join_key")).cast("long").alias("join_key_count"),
        F.sum("rows_week").cast("long").alias("store_rows_week"),
        F.min("first_d").alias("first_sale"), F.max("last_d").alias("last_sale"))
    return out


ORACLE["store_stats_by_retailer"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), """k AS (
  SELECT *, TRY_CAST(CAST(store AS VARCHAR) || coalesce(CAST(retailer_order AS VARCHAR), '') AS BIGINT) AS join_key FROM pos)""") + f"""
SELECT retailer, CAST(sum(value) AS DOUBLE) AS total_sales,
       CAST(sum(value) FILTER (WHERE product = '{PRODUCT}') AS DOUBLE) AS product_sales,
       CAST(count(DISTINCT store) + max(CASE WHEN store IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS store_count,
       CAST(count(DISTINCT join_key) + max(CASE WHEN join_key IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS join_key_count,
       CAST(count(store) FILTER (WHERE sale_date BETWEEN first_d AND last_d) AS BIGINT) AS store_rows_week,
       min(sale_date) AS first_sale, max(sale_date) AS last_sale
FROM k, a GROUP BY retailer"""


# --------------------------------------------- store-filter removal toggle

@query("store_total_toggle")
def store_total_toggle(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Per store: the weekly measures as filtered ('Filtered Stores') and
    with the store filter removed, i.e. the retailer total ('All Stores')."""
    t = Tables(spark, sf_dir)
    wins = {"ty": M.weekly_window(sel, N_WEEKS), "ly": M.weekly_window(sel, N_WEEKS, last_year=True)}
    per_store = M.window_sums(t, wins, ["retailer", "store"])
    totals = per_store.groupBy("retailer").agg(F.sum("ty").alias("ty_all"), F.sum("ly").alias("ly_all"))
    # Null-safe: stores without a retailer belong to the blank member's total.
    totals = totals.withColumnRenamed("retailer", "_total_of")
    j = per_store.join(totals, F.col("retailer").eqNullSafe(F.col("_total_of")), "left").drop("_total_of")
    # Both toggle settings as rows (the toggle table has two fixed rows).
    both = j.select("retailer", "store", F.explode(F.array(
        F.struct(F.lit("All Stores").alias("custom_total"), F.col("ty_all").alias("ty_sales"),
                 F.col("ly_all").alias("ly_sales")),
        F.struct(F.lit("Filtered Stores").alias("custom_total"), F.col("ty").alias("ty_sales"),
                 F.col("ly").alias("ly_sales")))).alias("x")).select("retailer", "store", "x.*")
    both = both.withColumn("wk_pct", B.weekly_pct_change(F.col("ty_sales"), F.col("ly_sales")))
    return M.as_double(both, ["ty_sales", "ly_sales"])


ORACLE["store_total_toggle"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), f"""ps AS (
  SELECT retailer, store,
         sum(value) FILTER (WHERE sale_date BETWEEN e_ty - {_NW} AND e_ty) AS ty,
         sum(value) FILTER (WHERE sale_date BETWEEN e_ly - {_NW} AND e_ly) AS ly
  FROM pos, a WHERE sale_date BETWEEN e_ly - {_NW} AND e_ty GROUP BY retailer, store),
tot AS (SELECT retailer, sum(ty) AS ty_all, sum(ly) AS ly_all FROM ps GROUP BY retailer),
both_ AS (
  SELECT ps.retailer, ps.store, 'All Stores' AS custom_total, ty_all AS t, ly_all AS l
  FROM ps JOIN tot ON ps.retailer IS NOT DISTINCT FROM tot.retailer
  UNION ALL
  SELECT retailer, store, 'Filtered Stores', ty, ly FROM ps)""") + f"""
SELECT retailer, store, custom_total, {S.dbl('t')} AS ty_sales, {S.dbl('l')} AS ly_sales,
       {S.weekly_pct('t', 'l')} AS wk_pct FROM both_"""


# ------------------------------------------------------- hierarchy rollup

@query("hierarchy_rollup")
def hierarchy_rollup(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """YTD sales rolled up SMM > SSR > store with grouping levels and the
    in-scope SSR name."""
    t = Tables(spark, sf_dir)
    per_store = M.window_sums(t, {"ytd_ty": M.ytd_window(sel)}, ["smm", "ssr", "store"])
    out = (per_store.rollup("smm", "ssr", "store")
           .agg(F.sum("ytd_ty").cast("double").alias("ytd_ty"),
                F.grouping_id("smm", "ssr", "store").cast("long").alias("level"),
                F.when(F.grouping("ssr") == 0, F.max("ssr")).alias("ssr_name")))
    return out


ORACLE["hierarchy_rollup"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), """ps AS (
  SELECT smm, ssr, store, sum(value) FILTER (WHERE sale_date BETWEEN ys_ty AND ye_ty) AS ytd_ty
  FROM pos, a WHERE sale_date BETWEEN ys_ty AND ye_ty GROUP BY smm, ssr, store)""") + """
SELECT smm, ssr, store, CAST(sum(ytd_ty) AS DOUBLE) AS ytd_ty,
       CAST(GROUPING(smm, ssr, store) AS BIGINT) AS level,
       CASE WHEN GROUPING(ssr) = 0 THEN max(ssr) END AS ssr_name
FROM ps GROUP BY ROLLUP (smm, ssr, store)"""


# -------------------------------------------------------------------- ranks

@query("store_ytd_rank")
def store_ytd_rank(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Dense rank (descending) of the coverage-file stores by YTD sales;
    stores with blank sales get no rank."""
    t = Tables(spark, sf_dir)
    per_store = M.window_sums(t, {"ytd_ty": M.ytd_window(sel)}, ["store", "in_coverage"])
    per_store = per_store.where(F.col("in_coverage")).drop("in_coverage")
    ranked = global_rank(per_store, "ytd_ty", "ytd_rank", method="dense")
    return ranked.select("store", F.col("ytd_ty").cast("double").alias("ytd_ty"), "ytd_rank")


ORACLE["store_ytd_rank"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), """ps AS (
  SELECT store, sum(value) AS ytd_ty FROM pos, a WHERE sale_date BETWEEN ys_ty AND ye_ty AND in_coverage
  GROUP BY store)""") + """
SELECT store, CAST(ytd_ty AS DOUBLE) AS ytd_ty,
       CASE WHEN ytd_ty IS NOT NULL THEN CAST(dense_rank() OVER (ORDER BY ytd_ty DESC) AS BIGINT) END AS ytd_rank
FROM ps"""


def _level_ytd(t: Tables, sel: M.Selection, level: str) -> DataFrame:
    wins = {"ytd_ty": M.ytd_window(sel), "ytd_ly": M.ytd_window(sel, last_year=True)}
    return M.with_change(M.window_sums(t, wins, [level]), "ytd_ty", "ytd_ly", "ytd", pct="ytd")


def level_pct_rank(spark: SparkSession, sf_dir: str, level: str, sel: M.Selection = SEL, rank_blank: bool = False) -> DataFrame:
    """Dense rank of a level's members (a code table) by YTD % change."""
    df = level_rank(_level_ytd(Tables(spark, sf_dir), sel, level), "ytd_pct", "pct_rank", rank_blank=rank_blank)
    return M.as_double(df.select(level, "ytd_ty", "ytd_ly", "ytd_pct", "pct_rank"), ["ytd_ty", "ytd_ly"])


def _level_sql(level: str) -> str:
    column = {"ssr_name": "ssr", "smm_territory": "(CASE WHEN strpos(smm, 'Cov') > 0 THEN smm WHEN smm IS NOT NULL THEN 'Covered' END)"}
    return _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), f"""lv AS (
  SELECT {column.get(level, level)} AS {level}, sum(value) FILTER (WHERE sale_date BETWEEN ys_ty AND ye_ty) AS ytd_ty,
         sum(value) FILTER (WHERE sale_date BETWEEN ys_ly AND ye_ly) AS ytd_ly
  FROM pos, a WHERE sale_date BETWEEN ys_ly AND ye_ty GROUP BY 1)""",
                 f"p AS (SELECT *, {S.ytd_pct('ytd_ty', 'ytd_ly')} AS ytd_pct FROM lv)")


def _pct_rank_sql(level: str, rank_blank: bool = False) -> str:
    rank = "CAST(dense_rank() OVER (ORDER BY ytd_pct DESC NULLS LAST) AS BIGINT)"
    if not rank_blank:
        rank = f"CASE WHEN ytd_pct IS NOT NULL THEN {rank} END"
    return _level_sql(level) + f"""
SELECT {level}, CAST(ytd_ty AS DOUBLE) AS ytd_ty, CAST(ytd_ly AS DOUBLE) AS ytd_ly, ytd_pct, {rank} AS pct_rank FROM p"""


@query("ssr_pct_rank", _pct_rank_sql("ssr"))
def ssr_pct_rank(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Dense rank of the SSRs by YTD % change."""
    return level_pct_rank(spark, sf_dir, "ssr", sel)


@query("smm_pct_rank", _pct_rank_sql("smm"))
def smm_pct_rank(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Dense rank of the SMMs by YTD % change."""
    return level_pct_rank(spark, sf_dir, "smm", sel)


@query("ssr_name_pct_rank", _pct_rank_sql("ssr_name"))
def ssr_name_pct_rank(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Dense rank of the SSR names by YTD % change."""
    return level_pct_rank(spark, sf_dir, "ssr_name", sel)


@query("ssr_rank_with_blanks", _pct_rank_sql("ssr", True))
def ssr_rank_with_blanks(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Dense rank of all SSRs by YTD % change, blank changes ranked too."""
    return level_pct_rank(spark, sf_dir, "ssr", sel, rank_blank=True)


RANK_LEVELS = ("ssr", "smm", "ssr_name", "smm_territory")


def rank_by_level(spark: SparkSession, sf_dir: str, level: str, sel: M.Selection = SEL) -> DataFrame:
    """Rank of each member at ``level``: by YTD TY sales when its LY is
    blank, otherwise by YTD % change (both dense, over all members)."""
    if level not in RANK_LEVELS:
        raise ValueError(f"level {level!r} is not one of {RANK_LEVELS}")
    df = _level_ytd(Tables(spark, sf_dir), sel, level)
    df = level_rank(level_rank(df, "ytd_ty", "rank_ty"), "ytd_pct", "rank_pct")
    df = df.withColumn("ytd_rank", F.when(F.col("ytd_ly").isNull(), F.col("rank_ty")).otherwise(F.col("rank_pct")))
    return M.as_double(df.select(level, "ytd_ty", "ytd_ly", "ytd_rank"), ["ytd_ty", "ytd_ly"])


def _dispatch_sql(level: str) -> str:
    return _level_sql(level) + f""", r AS (
  SELECT *, CASE WHEN ytd_ty IS NOT NULL THEN dense_rank() OVER (ORDER BY ytd_ty DESC NULLS LAST) END AS rank_ty,
         dense_rank() OVER (ORDER BY ytd_pct DESC NULLS LAST) AS rank_pct FROM p)
SELECT {level}, CAST(ytd_ty AS DOUBLE) AS ytd_ty, CAST(ytd_ly AS DOUBLE) AS ytd_ly,
       CAST(CASE WHEN ytd_ly IS NULL THEN rank_ty ELSE rank_pct END AS BIGINT) AS ytd_rank FROM r"""


@query("rank_dispatch", _dispatch_sql("ssr"))
def rank_dispatch(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL, level: str = "ssr") -> DataFrame:
    """Rank dispatch of the SSRs (or another level)."""
    return rank_by_level(spark, sf_dir, level, sel)


@query("rank_dispatch_smm_territory", _dispatch_sql("smm_territory"))
def rank_dispatch_smm_territory(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Rank dispatch of the SMM territories."""
    return rank_by_level(spark, sf_dir, "smm_territory", sel)


@query("rank_dispatch_smm", _dispatch_sql("smm"))
def rank_dispatch_smm(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Rank dispatch of the SMMs."""
    return rank_by_level(spark, sf_dir, "smm", sel)


def _retailer_product_ty(t: Tables, sel: M.Selection) -> DataFrame:
    return M.window_sums(t, {"ty_sales": M.weekly_window(sel, N_WEEKS)}, ["product", "retailer"])


@query("retailer_rank_by_product")
def retailer_rank_by_product(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Skip rank of the retailers by N-week sales within each product."""
    t = Tables(spark, sf_dir)
    df = group_rank(_retailer_product_ty(t, sel), ["product"], "ty_sales", "retailer_rank", method="skip")
    return M.as_double(df, ["ty_sales"])


_RP_CTE = f"""rp AS (
  SELECT product, retailer, sum(value) AS ty_sales FROM pos, a
  WHERE sale_date BETWEEN e_ty - {_NW} AND e_ty GROUP BY product, retailer)"""
_RK_CTE = "rk AS (SELECT *, rank() OVER (PARTITION BY product ORDER BY ty_sales DESC) AS r FROM rp)"
ORACLE["retailer_rank_by_product"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), _RP_CTE) + """
SELECT product, retailer, CAST(ty_sales AS DOUBLE) AS ty_sales,
       CAST(rank() OVER (PARTITION BY product ORDER BY ty_sales DESC) AS BIGINT) AS retailer_rank FROM rp"""


@query("retailer_total_rank", _with(S.POS_FACT_CTE) + """
SELECT retailer, CAST(sum(value) AS DOUBLE) AS total_sales,
       CAST(rank() OVER (ORDER BY sum(value) DESC NULLS LAST) AS BIGINT) AS total_rank FROM pos GROUP BY retailer""")
def retailer_total_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skip rank of the retailers by their total sales."""
    t = Tables(spark, sf_dir)
    per_store = R.sales_lines(t).groupBy("store").agg(F.sum("value").alias("v"))
    df = R.attach_dims(per_store, t, ["retailer"]).groupBy("retailer").agg(F.sum("v").alias("total_sales"))
    return M.as_double(level_rank(df, "total_sales", "total_rank", method="skip", rank_blank=True), ["total_sales"])


@query("retailer_at_rank_k")
def retailer_at_rank_k(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Per product and k = 1..6: the retailer ranked k (NULL on a tie or
    when nobody holds rank k)."""
    t = Tables(spark, sf_dir)
    ranked = group_rank(_retailer_product_ty(t, sel), ["product"], "ty_sales", "retailer_rank", method="skip")
    return member_at_rank(ranked, ["product"], "retailer_rank", "retailer", RANK_KS)


ORACLE["retailer_at_rank_k"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), _RP_CTE, _RK_CTE,
                                     """ks AS (SELECT CAST(k AS BIGINT) AS k FROM (VALUES (1),(2),(3),(4),(5),(6)) v(k)),
g AS (SELECT DISTINCT product FROM rp),
hits AS (SELECT product, r AS k, count(*) AS c, min(retailer) AS m FROM rk GROUP BY product, r)""") + """
SELECT g.product, ks.k, CASE WHEN hits.c = 1 THEN hits.m END AS retailer_at_k
FROM g CROSS JOIN ks LEFT JOIN hits ON hits.product IS NOT DISTINCT FROM g.product AND hits.k = ks.k"""


@query("retailer_rank_flags", _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), _RP_CTE, _RK_CTE) + f"""
SELECT product, retailer, CAST(r AS BIGINT) AS retailer_rank,
       {', '.join(f'CAST(CASE WHEN r = {k} THEN 1 END AS INTEGER) AS is_rank_{k}' for k in RANK_KS)} FROM rk""")
def retailer_rank_flags(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Per product and retailer: its rank and, for k = 1..6, 1 where it holds
    rank k (blank elsewhere)."""
    t = Tables(spark, sf_dir)
    ranked = group_rank(_retailer_product_ty(t, sel), ["product"], "ty_sales", "retailer_rank", method="skip")
    return rank_flags(ranked, "retailer_rank", RANK_KS).drop("ty_sales")


# ------------------------------------------- selected retailer vs the rest

def _side_aggs(week):
    def extra(pre: bool):
        if pre:
            return [F.count(F.when(week.contains(F.col("sale_date")), F.col("store"))).alias("store_rows")]
        return [F.sum("store_rows").cast("long").alias("store_rows")]
    return extra


@query("selected_vs_rest")
def selected_vs_rest(spark: SparkSession, sf_dir: str, retailer: str = RETAILER,
                     sel: M.Selection = SEL) -> DataFrame:
    """The selected retailer against all others (and everything): sales,
    changes, store rows and trend."""
    t = Tables(spark, sf_dir)
    week = M.selected_week_window(sel)
    wins = {"ty_sales": M.weekly_window(sel, N_WEEKS), "ly_sales": M.weekly_window(sel, N_WEEKS, last_year=True)}
    env = M.envelope(list(wins.values()) + [week])
    lines = R.sales_lines(t, env)
    pre = lines.groupBy("store").agg(*M._cond_sums(wins), *_side_aggs(week)(True))
    fact = R.attach_dims(pre, t, ["retailer"]).withColumn(
        "side", F.when(F.col("retailer") == retailer, F.lit("selected")).otherwise(F.lit("others")))
    sums = [F.sum(n).alias(n) for n in wins] + _side_aggs(week)(False)
    # One pass: per side, plus the grand total with every filter cleared.
    df = fact.rollup("side").agg(*sums).withColumn("side", F.coalesce(F.col("side"), F.lit("all")))
    df = M.with_change(df, "ty_sales", "ly_sales", "wk", pct="weekly")
    df = df.withColumn("trend", B.sign_class(F.col("wk_pct")))
    return M.as_double(df, list(wins))


ORACLE["selected_vs_rest"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), f"""agg AS (
  SELECT CASE WHEN retailer = '{RETAILER}' THEN 'selected' ELSE 'others' END AS side,
         sum(value) FILTER (WHERE sale_date BETWEEN e_ty - {_NW} AND e_ty) AS ty,
         sum(value) FILTER (WHERE sale_date BETWEEN e_ly - {_NW} AND e_ly) AS ly,
         CAST(count(store) FILTER (WHERE sale_date BETWEEN first_d AND last_d) AS BIGINT) AS store_rows
  FROM pos, a WHERE sale_date BETWEEN e_ly - {_NW} AND e_ty GROUP BY GROUPING SETS ((1), ()))""") + f"""
SELECT coalesce(side, 'all') AS side, {S.dbl('ty')} AS ty_sales, {S.dbl('ly')} AS ly_sales, store_rows,
       {S.dbl(S.blank_sub('ty', 'ly'))} AS wk_change, {S.weekly_pct('ty', 'ly')} AS wk_pct,
       {S.sign(S.weekly_pct('ty', 'ly'))} AS trend
FROM agg"""


@query("customer_vs_others")
def customer_vs_others(spark: SparkSession, sf_dir: str, selected=CUSTOMERS, sel: M.Selection = SEL) -> DataFrame:
    """Axis = selected retailers plus a pooled 'Others' member, stacked by
    retailer; value = N-week TY sales."""
    t = Tables(spark, sf_dir)
    per = M.window_sums(t, {"ty_sales": M.weekly_window(sel, N_WEEKS)}, ["retailer"])
    out = per.withColumn("axis", pooled_member("retailer", selected))
    return M.as_double(out.select("axis", "retailer", "ty_sales"), ["ty_sales"])


ORACLE["customer_vs_others"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte()) + f"""
SELECT CASE WHEN retailer IN {tuple(CUSTOMERS)} THEN retailer ELSE 'Others' END AS axis, retailer,
       CAST(sum(value) AS DOUBLE) AS ty_sales
FROM pos, a WHERE sale_date BETWEEN e_ty - {_NW} AND e_ty GROUP BY retailer"""


@query("trend_class")
def trend_class(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Up / flat / down (1 / 0 / -1) per SSR, driven by the weekly % change
    (the arrow shown in the month-to-date column, labelled here by what it
    computes) and by the YTD % change; a BLANK or zero change is flat."""
    t = Tables(spark, sf_dir)
    wins = {"ty": M.weekly_window(sel, N_WEEKS), "ly": M.weekly_window(sel, N_WEEKS, last_year=True),
            "ytd_ty": M.ytd_window(sel), "ytd_ly": M.ytd_window(sel, last_year=True)}
    df = M.window_sums(t, wins, ["ssr"])
    return df.select("ssr",
                     B.sign_class(B.weekly_pct_change(F.col("ty"), F.col("ly"))).alias("weekly_trend"),
                     B.sign_class(B.ytd_pct_change(F.col("ytd_ty"), F.col("ytd_ly"))).alias("ytd_trend"))


ORACLE["trend_class"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), f"""agg AS (
  SELECT ssr,
    sum(value) FILTER (WHERE sale_date BETWEEN e_ty - {_NW} AND e_ty) AS ty,
    sum(value) FILTER (WHERE sale_date BETWEEN e_ly - {_NW} AND e_ly) AS ly,
    sum(value) FILTER (WHERE sale_date BETWEEN ys_ty AND ye_ty) AS ytd_ty,
    sum(value) FILTER (WHERE sale_date BETWEEN ys_ly AND ye_ly) AS ytd_ly
  FROM pos, a WHERE sale_date BETWEEN least(ys_ly, e_ly - {_NW}) AND greatest(ye_ty, e_ty)
  GROUP BY ssr)""") + f"""
SELECT ssr, {S.sign(S.weekly_pct('ty', 'ly'))} AS weekly_trend, {S.sign(S.ytd_pct('ytd_ty', 'ytd_ly'))} AS ytd_trend
FROM agg"""


# ------------------------------------------------- SQL API: top-k stores

TOP_K = 10


@query("top_stores_sql")
def top_stores_sql(spark: SparkSession, sf_dir: str, k: int = TOP_K, year: int = SEL.year) -> DataFrame:
    """Top-k stores by sales in a calendar year, written with the SQL API
    over a temp view (the limit is the feature: a top-k report)."""
    Tables(spark, sf_dir).lineitem.createOrReplaceTempView("ll_lineitem")
    return spark.sql(f"""
        SELECT l_suppkey AS store, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sales
        FROM ll_lineitem
        WHERE l_shipdate >= TIMESTAMP_NTZ '{int(year)}-01-01 00:00:00' AND l_shipdate < TIMESTAMP_NTZ '{int(year) + 1}-01-01 00:00:00'
        GROUP BY l_suppkey ORDER BY sales DESC, store LIMIT {k}""")


ORACLE["top_stores_sql"] = f"""SELECT l_suppkey AS store, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sales
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01 00:00:00' AND l_shipdate < TIMESTAMP '2001-01-01 00:00:00'
GROUP BY l_suppkey ORDER BY sales DESC, store LIMIT {TOP_K}"""


# ------------------------------------------ last-N-months parameter sweep

# First and last N of the parameter series.
SWEEP = (1, 100)


@query("last_n_months_sweep")
def last_n_months_sweep(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL, series: tuple[int, int] = SWEEP) -> DataFrame:
    """Sales in the last N months for every N of the parameter series: sums
    per retailer and month, and one running sum over the months back (as
    many rows per retailer as the series has values)."""
    from pyspark.sql import Window

    from ..sources.params import number_series
    t = Tables(spark, sf_dir)
    first, last = series
    window = M.last_n_months_window(sel, last)
    back = lambda d: ((F.lit(window.end.year) - F.year(d)) * 12 + F.lit(window.end.month) - F.month(d) + 1).cast("long")
    monthly = (R.sales_lines(t, window).groupBy("store", back(F.col("sale_date")).alias("n_months")).agg(F.sum("value").alias("v")))
    monthly = R.attach_dims(monthly, t, ["retailer"]).groupBy("retailer", "n_months").agg(F.sum("v").alias("v"))
    # One row per retailer and N, the N without sales of their own included.
    axis = monthly.select("retailer").distinct().select(
        "retailer", F.explode(F.sequence(F.lit(1), F.lit(last)).cast("array<long>")).alias("n_months"), F.lit(None).cast("decimal(28,2)").alias("v"))
    months = monthly.select("retailer", "n_months", F.col("v").cast("decimal(28,2)").alias("v")).unionByName(axis)
    months = months.groupBy("retailer", "n_months").agg(F.sum("v").alias("v"))
    w = Window.partitionBy("retailer").orderBy("n_months").rowsBetween(Window.unboundedPreceding, 0)
    run = months.select("retailer", "n_months", F.sum("v").over(w).cast("double").alias("sales"))
    values = F.broadcast(number_series(spark, first, last, name="n_months"))      # the parameter's own rows
    return run.join(values, "n_months", "inner").select("retailer", "n_months", "sales")


def _sweep_sql() -> str:
    first, last = SWEEP
    return _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), f"""n AS (SELECT CAST(range AS BIGINT) AS n_months FROM range({first}, {last + 1})),
f AS (SELECT retailer, sale_date, value, last_d FROM pos, a
      WHERE sale_date BETWEEN date_trunc('month', last_d - INTERVAL {last - 1} MONTH) AND last_d),
m AS (SELECT retailer, CAST((year(any_value(last_d)) - year(date_trunc('month', sale_date))) * 12
             + month(any_value(last_d)) - month(date_trunc('month', sale_date)) AS BIGINT) AS back, sum(value) AS v
      FROM f GROUP BY retailer, date_trunc('month', sale_date)),
r AS (SELECT DISTINCT retailer FROM f)""") + """
SELECT r.retailer, n.n_months, CAST((SELECT sum(v) FROM m WHERE m.retailer IS NOT DISTINCT FROM r.retailer AND m.back < n.n_months) AS DOUBLE) AS sales
FROM r, n"""


ORACLE["last_n_months_sweep"] = _sweep_sql()


# ------------------------------------- products with sales (semi join)

@query("active_products")
def active_products(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Product members that have sales in the year-to-week window: the
    product dimension filtered by the fact (a semi join on the distinct
    part keys of the window, reduced map-side before the shuffle)."""
    t = Tables(spark, sf_dir)
    sold = R.sales_lines(t, M.ytd_window(sel)).select("part_key").distinct()
    parts = R.product_dim(t).join(sold, "part_key", "left_semi")
    return parts.groupBy("product").agg(F.count(F.lit(1)).alias("n_parts_sold"))


ORACLE["active_products"] = _with(S.calendar_cte(), _anchor_cte()) + """
SELECT upper(trim(p_brand)) AS product, count(*) AS n_parts_sold FROM part
WHERE p_partkey IN (SELECT l_partkey FROM lineitem, a WHERE CAST(l_shipdate AS DATE) BETWEEN ys_ty AND ye_ty)
GROUP BY 1"""


# ------------------------------------------ product-filtered N-week sales

@query("product_filtered_nweek")
def product_filtered_nweek(spark: SparkSession, sf_dir: str, product: str = PRODUCT,
                           sel: M.Selection = SEL) -> DataFrame:
    """4- and 13-week sales of one product by retailer (the product selection
    reaches the fact as a semi join)."""
    t = Tables(spark, sf_dir)
    wins = {"ty_4w": M.weekly_window(sel, 4), "ty_13w": M.weekly_window(sel, 13)}
    df = M.window_sums(t, wins, ["retailer"], where=F.col("product") == product, where_cols=["product"])
    return M.as_double(df, list(wins))


ORACLE["product_filtered_nweek"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte()) + f"""
SELECT retailer, CAST(sum(value) FILTER (WHERE sale_date BETWEEN e_ty - 27 AND e_ty) AS DOUBLE) AS ty_4w,
       CAST(sum(value) FILTER (WHERE sale_date BETWEEN e_ty - 90 AND e_ty) AS DOUBLE) AS ty_13w
FROM pos, a WHERE product = '{PRODUCT}' AND sale_date BETWEEN e_ty - 90 AND e_ty GROUP BY retailer"""


# ------------------------------------- calendar levels: year > quarter > month

@query("sales_by_calendar_levels")
def sales_by_calendar_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales over the whole history on a calendar padded to whole years,
    rolled up Year > Quarter > Month (days without sales count as 0 rows;
    months without sales keep a row with BLANK sales)."""
    t = Tables(spark, sf_dir)
    per_day = R.sales_lines(t).groupBy("sale_date").agg(F.sum("value").alias("v"), F.count(F.lit(1)).alias("n"))
    bounds = t.lineitem.agg(F.to_date(F.min("l_shipdate")).alias("lo"), F.to_date(F.max("l_shipdate")).alias("hi"))
    cal = CD.calendar_attributes(CD.calendar_from_bounds(CD.padded_bounds(bounds)))
    j = cal.join(per_day.withColumnRenamed("sale_date", "date"), "date", "left")   # one row per day on both sides
    return (j.rollup("year", "quarter_no", "month")
             .agg(F.sum("v").cast("double").alias("sales"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_lines"),
                  F.count(F.lit(1)).cast("long").alias("n_days"),
                  F.grouping_id("year", "quarter_no", "month").cast("long").alias("level")))


ORACLE["sales_by_calendar_levels"] = _with(
    S.calendar_cte("(SELECT make_date(year(min(l_shipdate)), 1, 1) FROM lineitem)",
                   "(SELECT make_date(year(max(l_shipdate)), 12, 31) FROM lineitem)"),
    """pd AS (SELECT CAST(l_shipdate AS DATE) AS d, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v, count(*) AS n
               FROM lineitem GROUP BY 1)""") + """
SELECT CAST(year(c.d) AS INTEGER) AS year, CAST(quarter(c.d) AS INTEGER) AS quarter_no, CAST(month(c.d) AS INTEGER) AS month,
       CAST(sum(pd.v) AS DOUBLE) AS sales, CAST(coalesce(sum(pd.n), 0) AS BIGINT) AS n_lines, count(*) AS n_days,
       CAST(GROUPING(year(c.d), quarter(c.d), month(c.d)) AS BIGINT) AS level
FROM cal c LEFT JOIN pd ON pd.d = c.d
GROUP BY ROLLUP (year(c.d), quarter(c.d), month(c.d))"""


# -------------------------------------------- last date of every week

@query("week_end_dates")
def week_end_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every (year, week) selection of the calendar: the last date of
    that year whose plain WEEKNUM equals the selected week and whose week is
    not 53, as MM-dd-yyyy text (BLANK when none)."""
    cal, _ = _fact_calendar(Tables(spark, sf_dir))
    axis = cal.select("year", "week").distinct()
    last = (cal.where(F.col("week") != 53).groupBy("year", F.col("weeknum").alias("week"))
               .agg(F.date_format(F.max("date"), "MM-dd-yyyy").alias("week_end_date")))
    return axis.join(last, ["year", "week"], "left")


ORACLE["week_end_dates"] = _with(S.calendar_cte()) + f"""
, c2 AS (SELECT *, CAST(floor((dayofyear(d) + {S.dow("make_date(year(d), 1, 1)")} - 2) / 7) AS INTEGER) + 1 AS weeknum FROM cal),
last AS (SELECT y, weeknum, strftime(max(d), '%m-%d-%Y') AS week_end_date FROM c2 WHERE wk <> 53 GROUP BY y, weeknum)
SELECT a.y AS year, a.wk AS week, last.week_end_date
FROM (SELECT DISTINCT y, wk FROM cal) a LEFT JOIN last ON last.y = a.y AND last.weeknum = a.wk"""


# ------------------------------------------------------ metric selector

# Selector rows of the metric choice table (label, order).
METRIC_SELECTOR = [("MTD Sales", 1), ("YTD Sales", 2), ("Yearly % Change", 3), ("Weekly % Change", 4)]


@query("metric_selector")
def metric_selector(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Every selector row of the metric choice table per retailer: the
    chosen metric's value, the selector's remapped column order and its
    category by contained text."""
    from ..operators.report import choose_metric
    from ..sources.params import cascade_remap, contains_category
    t = Tables(spark, sf_dir)
    wins = {"mtd_ty": M.mtd_window(sel), "ytd_ty": M.ytd_window(sel), "ytd_ly": M.ytd_window(sel, last_year=True),
            "ty": M.weekly_window(sel, N_WEEKS), "ly": M.weekly_window(sel, N_WEEKS, last_year=True)}
    df = M.window_sums(t, wins, ["retailer"])
    df = df.select("retailer", F.col("mtd_ty").cast("double").alias("mtd_ty"), F.col("ytd_ty").cast("double").alias("ytd_ty"),
                   B.ytd_pct_change(F.col("ytd_ty"), F.col("ytd_ly")).alias("ytd_pct"),
                   B.weekly_pct_change(F.col("ty"), F.col("ly")).alias("wk_pct"))
    rows = df.select("*", F.explode(F.array(*[F.struct(F.lit(l).alias("selector"), F.lit(o).alias("sel_order"))
                                              for l, o in METRIC_SELECTOR])).alias("s")).select("*", "s.*").drop("s")
    options = {"MTD Sales": "mtd_ty", "YTD Sales": "ytd_ty", "Yearly % Change": "ytd_pct", "Weekly % Change": "wk_pct"}
    return rows.select("retailer", "selector", choose_metric(rows, "selector", options).alias("value"),
                       cascade_remap(F.col("sel_order")).alias("column_order"),
                       contains_category(F.col("selector"), [("%", "Change"), ("Sales", "Sales")]).alias("category"))


def _selector_sql() -> str:
    vals = {"MTD Sales": "CAST(mtd_ty AS DOUBLE)", "YTD Sales": "CAST(ytd_ty AS DOUBLE)",
            "Yearly % Change": S.ytd_pct("ytd_ty", "ytd_ly"), "Weekly % Change": S.weekly_pct("ty", "ly")}
    remap = "CAST(CASE WHEN o = 1 THEN 10 WHEN o = 2 THEN 1 WHEN o BETWEEN 3 AND 11 THEN o - 1 ELSE o END AS INTEGER)"
    rows = " UNION ALL ".join(
        f"SELECT retailer, '{l}' AS selector, {vals[l]} AS value, {remap.replace('o', str(o))} AS column_order, "
        f"'{'Change' if '%' in l else 'Sales'}' AS category FROM agg" for l, o in METRIC_SELECTOR)
    return _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), f"""agg AS (
  SELECT retailer,
    sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('month', last_d) AND last_d) AS mtd_ty,
    sum(value) FILTER (WHERE sale_date BETWEEN ys_ty AND ye_ty) AS ytd_ty,
    sum(value) FILTER (WHERE sale_date BETWEEN ys_ly AND ye_ly) AS ytd_ly,
    sum(value) FILTER (WHERE sale_date BETWEEN e_ty - {_NW} AND e_ty) AS ty,
    sum(value) FILTER (WHERE sale_date BETWEEN e_ly - {_NW} AND e_ly) AS ly
  FROM pos, a WHERE sale_date BETWEEN least(ys_ly, e_ly - {_NW}) AND greatest(ye_ty, e_ty, last_d)
  GROUP BY retailer)""") + rows


ORACLE["metric_selector"] = _selector_sql()


# ------------------------------------- N-week TY / LY for every week of a year

@query("weekly_ty_ly_by_week")
def weekly_ty_ly_by_week(spark: SparkSession, sf_dir: str, year: int = SEL.year, n_weeks: int = N_WEEKS) -> DataFrame:
    """The N-week TY and LY sales for every week of ``year`` by retailer --
    a report with weeks on the axis, where each row has its own anchor."""
    import datetime as _dt
    from ..functions import calendar as C
    weeks = sorted({C.py_week_no(_dt.date(year, 1, 1) + _dt.timedelta(days=i))
                    for i in range((_dt.date(year + 1, 1, 1) - _dt.date(year, 1, 1)).days)})
    sel = [(w, C.anchor_week_ending(year, w), C.anchor_week_ending(year - 1, w)) for w in weeks]
    anchors = [a for _, ty, ly in sel for a in (ty, ly) if a is not None]
    sums = M.weekly_anchored_sums(Tables(spark, sf_dir), min(anchors), max(anchors), n_weeks, ["retailer"])
    # One row per week of the year: a parameter table of at most 54 rows.
    axis = spark.createDataFrame(sel, "week int, e_ty date, e_ly date")
    # Each weekly sum serves one week as TY and another as LY; the two meet by
    # grouping, so the blank retailer keeps one row.
    ends = axis.select("week", F.explode(F.array(
        F.struct(F.col("e_ty").alias("anchor"), F.lit(True).alias("is_ty")),
        F.struct(F.col("e_ly").alias("anchor"), F.lit(False).alias("is_ty")))).alias("x")).select("week", "x.*")
    out = (sums.join(F.broadcast(ends), "anchor").groupBy("week", "retailer")
               .agg(F.sum(F.when(F.col("is_ty"), F.col("sales"))).alias("ty_sales"),
                    F.sum(F.when(~F.col("is_ty"), F.col("sales"))).alias("ly_sales")))
    out = M.with_change(out, "ty_sales", "ly_sales", "wk", pct="weekly")
    return M.as_double(out, ["ty_sales", "ly_sales"])


def _weekly_by_week_sql(year: int = SEL.year, n: int = N_WEEKS) -> str:
    return _with(S.calendar_cte(), S.POS_FACT_CTE, f"""ys AS (SELECT DISTINCT CAST(strftime(d, '%Y') AS INTEGER) AS y, d FROM
         (SELECT CAST(gs AS DATE) AS d FROM generate_series(DATE '{year}-01-01', DATE '{year}-12-31', INTERVAL 1 DAY) g(gs))),
wk AS (SELECT DISTINCT {S.week_no('d')} AS week FROM ys),
e AS (SELECT y, wk, max(we) AS e FROM (SELECT CAST(year(d) AS INTEGER) AS y, {S.week_no('d')} AS wk, {S.week_ending('d')} AS we
       FROM (SELECT CAST(gs AS DATE) AS d FROM generate_series(DATE '{year - 1}-01-01', DATE '{year}-12-31', INTERVAL 1 DAY) g(gs)))
       GROUP BY y, wk),
sel AS (SELECT wk.week, t.e AS e_ty, l.e AS e_ly FROM wk LEFT JOIN e t ON t.y = {year} AND t.wk = wk.week
        LEFT JOIN e l ON l.y = {year - 1} AND l.wk = wk.week),
ty AS (SELECT s.week, p.retailer, sum(p.value) AS ty FROM sel s JOIN pos p ON p.sale_date BETWEEN s.e_ty - {7 * n - 1} AND s.e_ty
       GROUP BY s.week, p.retailer),
ly AS (SELECT s.week, p.retailer, sum(p.value) AS ly FROM sel s JOIN pos p ON p.sale_date BETWEEN s.e_ly - {7 * n - 1} AND s.e_ly
       GROUP BY s.week, p.retailer),
j AS (SELECT coalesce(ty.week, ly.week) AS week, coalesce(ty.retailer, ly.retailer) AS retailer, ty.ty, ly.ly
      FROM ty FULL OUTER JOIN ly ON ty.week = ly.week AND ty.retailer IS NOT DISTINCT FROM ly.retailer)""") + f"""
SELECT CAST(week AS INTEGER) AS week, retailer, {S.dbl('ty')} AS ty_sales, {S.dbl('ly')} AS ly_sales,
       {S.dbl(S.blank_sub('ty', 'ly'))} AS wk_change, {S.weekly_pct('ty', 'ly')} AS wk_pct FROM j"""


ORACLE["weekly_ty_ly_by_week"] = _weekly_by_week_sql()


@query("ytd_by_week")
def ytd_by_week(spark: SparkSession, sf_dir: str, year: int = SEL.year) -> DataFrame:
    """Year-to-week TY and LY sales for every week of ``year`` by retailer.
    Weekly sales are pre-aggregated (per store and retail week, then per
    retailer); each retailer gets its axis of weeks (a bounded explode);
    the axis and the TY / LY weekly rows are summed per (retailer, week) and
    running sums over each retailer's rows (at most two years of weeks)
    give both YTD values.  Weeks where both are BLANK are not shown."""
    import datetime as _dt

    from pyspark.sql import Window

    from ..functions import calendar as C
    t = Tables(spark, sf_dir)
    days = [_dt.date(year, 1, 1) + _dt.timedelta(days=i) for i in range((_dt.date(year + 1, 1, 1) - _dt.date(year, 1, 1)).days)]
    weeks = sorted({C.py_week_no(d) for d in days})
    lines = R.sales_lines(t, M.DateRange(_dt.date(year - 1, 1, 1), _dt.date(year, 12, 31)))
    weekly = (lines.groupBy("store", F.year("sale_date").alias("year"), C.week_no(F.col("sale_date")).alias("week"))
                   .agg(F.sum("value").alias("v")))
    per = R.attach_dims(weekly, t, ["retailer"]).groupBy("retailer", "year", "week").agg(F.sum("v").alias("v"))
    axis = (per.select("retailer").distinct()
               .select("retailer", F.explode(F.array(*[F.lit(w) for w in weeks])).alias("week"))
               .select("retailer", "week", F.lit(None).cast("decimal(28,2)").alias("v_ty"),
                       F.lit(None).cast("decimal(28,2)").alias("v_ly"), F.lit(True).alias("on_axis")))
    ty = per.where(F.col("year") == year).select("retailer", "week", F.col("v").alias("v_ty"),
                                                 F.lit(None).cast("decimal(28,2)").alias("v_ly"), F.lit(False).alias("on_axis"))
    ly = per.where(F.col("year") == year - 1).select("retailer", "week", F.lit(None).cast("decimal(28,2)").alias("v_ty"),
                                                     F.col("v").alias("v_ly"), F.lit(False).alias("on_axis"))
    timeline = (axis.unionByName(ty).unionByName(ly)
                    .groupBy("retailer", "week").agg(F.sum("v_ty").alias("v_ty"), F.sum("v_ly").alias("v_ly"),
                                                    F.max("on_axis").alias("on_axis")))
    w = Window.partitionBy("retailer").orderBy("week").rowsBetween(Window.unboundedPreceding, 0)
    run = timeline.select("retailer", "week", "on_axis", F.sum("v_ty").over(w).alias("ytd_ty"),
                          F.sum("v_ly").over(w).alias("ytd_ly"))
    run = run.where(F.col("on_axis") & (F.col("ytd_ty").isNotNull() | F.col("ytd_ly").isNotNull())).drop("on_axis")
    run = M.with_change(run.withColumn("week", F.col("week").cast("int")), "ytd_ty", "ytd_ly", "ytd", pct="ytd")
    return M.as_double(run, ["ytd_ty", "ytd_ly"])


def _ytd_by_week_sql(year: int = SEL.year) -> str:
    return _with(S.POS_FACT_CTE, f"""days AS (SELECT CAST(gs AS DATE) AS d FROM generate_series(DATE '{year}-01-01', DATE '{year}-12-31', INTERVAL 1 DAY) g(gs)),
wks AS (SELECT DISTINCT {S.week_no('d')} AS week FROM days),
f AS (SELECT retailer, CAST(year(sale_date) AS INTEGER) AS y, {S.week_no('sale_date')} AS week, value FROM pos
      WHERE sale_date BETWEEN DATE '{year - 1}-01-01' AND DATE '{year}-12-31'),
r AS (SELECT DISTINCT retailer FROM f),
axis AS (SELECT r.retailer, wks.week FROM r CROSS JOIN wks),
v AS (SELECT a.retailer, a.week,
             (SELECT sum(value) FROM f WHERE f.retailer IS NOT DISTINCT FROM a.retailer AND f.y = {year} AND f.week <= a.week) AS ty,
             (SELECT sum(value) FROM f WHERE f.retailer IS NOT DISTINCT FROM a.retailer AND f.y = {year - 1} AND f.week <= a.week) AS ly
      FROM axis a)""") + f"""
SELECT retailer, CAST(week AS INTEGER) AS week, {S.dbl('ty')} AS ytd_ty, {S.dbl('ly')} AS ytd_ly,
       {S.dbl(S.blank_sub('ty', 'ly'))} AS ytd_change, {S.ytd_pct('ty', 'ly')} AS ytd_pct
FROM v WHERE ty IS NOT NULL OR ly IS NOT NULL"""


ORACLE["ytd_by_week"] = _ytd_by_week_sql()


# ------------------------------------- every choice of the dynamic x-axis

AXIS_CHOICES = ("smm", "ssr", "retailer")


@query("axis_choice_report")
def axis_choice_report(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """The N-week TY / LY report for every choice of the switchable x-axis
    (SMM, SSR, retailer) at once: one aggregation over the per-store rows
    with grouping sets, labelled by the axis each row belongs to."""
    t = Tables(spark, sf_dir)
    wins = {"ty": M.weekly_window(sel, N_WEEKS), "ly": M.weekly_window(sel, N_WEEKS, last_year=True)}
    per_store = M.window_sums(t, wins, ["store", *AXIS_CHOICES])
    g = per_store.groupingSets([[c] for c in AXIS_CHOICES], *AXIS_CHOICES).agg(
        F.sum("ty").alias("ty_sales"), F.sum("ly").alias("ly_sales"),
        *[F.grouping(c).alias(f"_g_{c}") for c in AXIS_CHOICES])
    axis = None
    value = None
    for c in AXIS_CHOICES:
        cond = F.col(f"_g_{c}") == 0
        axis = F.when(cond, F.lit(c)) if axis is None else axis.when(cond, F.lit(c))
        value = F.when(cond, F.col(c)) if value is None else value.when(cond, F.col(c))
    out = g.select(axis.alias("axis"), value.alias("axis_value"), "ty_sales", "ly_sales")
    out = M.with_change(out, "ty_sales", "ly_sales", "wk", pct="weekly")
    return M.as_double(out, ["ty_sales", "ly_sales"])


ORACLE["axis_choice_report"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), f"""g AS (
  SELECT CASE WHEN GROUPING(smm) = 0 THEN 'smm' WHEN GROUPING(ssr) = 0 THEN 'ssr' ELSE 'retailer' END AS axis,
         CASE WHEN GROUPING(smm) = 0 THEN smm WHEN GROUPING(ssr) = 0 THEN ssr ELSE retailer END AS axis_value,
         sum(value) FILTER (WHERE sale_date BETWEEN e_ty - {_NW} AND e_ty) AS ty,
         sum(value) FILTER (WHERE sale_date BETWEEN e_ly - {_NW} AND e_ly) AS ly
  FROM pos, a WHERE sale_date BETWEEN e_ly - {_NW} AND e_ty
  GROUP BY GROUPING SETS ((smm), (ssr), (retailer)))""") + f"""
SELECT axis, axis_value, {S.dbl('ty')} AS ty_sales, {S.dbl('ly')} AS ly_sales,
       {S.dbl(S.blank_sub('ty', 'ly'))} AS wk_change, {S.weekly_pct('ty', 'ly')} AS wk_pct FROM g"""


@query("category_store_rank")
def category_store_rank(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Dense rank of the category fact's stores (customers) by calendar
    year-to-date category sales; blank sales get no rank."""
    t = Tables(spark, sf_dir)
    per_store = M.category_window_sums(t, {"cytd": M.calendar_ytd_window(sel)}, by=("store",))
    ranked = global_rank(per_store, "cytd", "cytd_rank", method="dense")
    return ranked.select("store", F.col("cytd").cast("double").alias("cytd"), "cytd_rank")


ORACLE["category_store_rank"] = _with(S.calendar_cte(), S.CATEGORY_FACT_CTE, _anchor_cte(), """ps AS (
  SELECT store, sum(value) AS cytd FROM cat, a
  WHERE sale_date BETWEEN date_trunc('year', last_d) AND last_d GROUP BY store)""") + """
SELECT store, CAST(cytd AS DOUBLE) AS cytd,
       CASE WHEN cytd IS NOT NULL THEN CAST(dense_rank() OVER (ORDER BY cytd DESC) AS BIGINT) END AS cytd_rank
FROM ps"""
