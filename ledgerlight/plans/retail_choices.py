"""What a report's choices select: parameter defaults, an axis with a pooled
member, sets that come from the fact, and the single member of a context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import blanks as B
from ..operators import measures as M
from ..operators.report import pooled_member
from ..sources import params as P
from ..sources import retail as R
from ..sources.tables import Tables
from . import sqlkit as S
from .registry import ORACLE, query
from .retail import N_MONTHS, N_WEEKS, SEL, _anchor_cte, _with
from .retail_more import CUSTOMERS, PRODUCT

_NW = 7 * N_WEEKS - 1


@query("parameter_defaults")
def parameter_defaults(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Sales by retailer for what the three parameters give when nothing, one value or
    several are selected: the week window takes the greatest choice in sight (of all: 9999,
    the year to week), week and month parameters their only value or the default 1 and 13."""
    t = Tables(spark, sf_dir)
    weeks = [*M.WEEK_CHOICES, M.YTD_CHOICE]
    wins = {"window_none": M.weekly_window(sel, M.greatest_choice((), weeks)),
            "window_several": M.weekly_window(sel, M.greatest_choice((4, 13), weeks)),
            "week_none": M.weekly_window(sel, M.sole_choice((), 1)),
            "week_one": M.weekly_window(sel, M.sole_choice((4,), 1)),
            "week_several": M.weekly_window(sel, M.sole_choice((4, 26), 1)),
            "months_none": M.last_n_months_window(sel, M.sole_choice((), N_MONTHS)),
            "months_one": M.last_n_months_window(sel, M.sole_choice((3,), N_MONTHS))}
    return M.as_double(M.window_sums(t, wins, ["retailer"]), list(wins))


def _months(n: int) -> str:
    return f"date_trunc('month', last_d - INTERVAL {n - 1} MONTH) AND last_d"


ORACLE["parameter_defaults"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), "agg AS (SELECT retailer, " + ", ".join(
    f"sum(value) FILTER (WHERE sale_date BETWEEN {w}) AS {n}" for n, w in (
        ("window_none", "ys_ty AND ye_ty"), ("window_several", "e_ty - 90 AND e_ty"), ("week_none", "e_ty - 6 AND e_ty"),
        ("week_one", "e_ty - 27 AND e_ty"), ("week_several", "e_ty - 6 AND e_ty"),
        ("months_none", _months(13)), ("months_one", _months(3)))) + f"""
  FROM pos, a WHERE sale_date BETWEEN {_months(13)} OR sale_date BETWEEN e_ty - 90 AND e_ty OR sale_date BETWEEN ys_ty AND ye_ty
  GROUP BY retailer)""") + "SELECT retailer, " + ", ".join(
    f"{S.dbl(n)} AS {n}" for n in ("window_none", "window_several", "week_none", "week_one", "week_several", "months_none", "months_one")) + " FROM agg"


@query("axis_with_others_sales")
def axis_with_others_sales(spark: SparkSession, sf_dir: str, selected=CUSTOMERS, sel: M.Selection = SEL) -> DataFrame:
    """The axis of all retailers and 'Others' with this year's N-week sales: a selected
    retailer has its own, 'Others' those of all that are not selected, and these are blank."""
    t = Tables(spark, sf_dir)
    per = M.window_sums(t, {"ty_sales": M.weekly_window(sel, N_WEEKS)}, ["retailer"])
    pooled = per.groupBy(pooled_member("retailer", selected).alias("member")).agg(F.sum("ty_sales").alias("ty_sales"))
    axis = P.axis_with_others(R.region_dim(t), "retailer").withColumnRenamed("retailer", "axis")
    out = axis.join(pooled, F.col("axis").eqNullSafe(F.col("member")), "left")
    return M.as_double(out.select("axis", "ty_sales"), ["ty_sales"])


ORACLE["axis_with_others_sales"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), f"""pooled AS (
  SELECT CASE WHEN retailer IN {tuple(CUSTOMERS)} THEN retailer ELSE 'Others' END AS member, sum(value) AS v
  FROM pos, a WHERE sale_date BETWEEN e_ty - {_NW} AND e_ty GROUP BY 1)""") + f"""
SELECT x.axis, {S.dbl('p.v')} AS ty_sales
FROM (SELECT DISTINCT r_name AS axis FROM region UNION ALL SELECT 'Others') x LEFT JOIN pooled p ON x.axis IS NOT DISTINCT FROM p.member"""


@query("stores_by_product_set")
def stores_by_product_set(spark: SparkSession, sf_dir: str, product: str = PRODUCT, sel: M.Selection = SEL) -> DataFrame:
    """This year's N-week sales by retailer of the stores that sold the product in the year
    to week (IN) and of those that did not (NOT IN). The set is found from the fact
    and may hold any number of stores: sums by store meet it in a semi and an anti join."""
    t = Tables(spark, sf_dir)
    sold = R.attach_dims(R.sales_lines(t, M.ytd_window(sel)).select("store", "part_key").distinct(), t, ["product"])
    members = sold.where(F.col("product") == product).select("store").distinct()
    per = R.sales_lines(t, M.weekly_window(sel, N_WEEKS)).groupBy("store").agg(F.sum("value").alias("v"))
    sides = [P.in_set(per, "store", members, "store", negate=out).withColumn("in_set", F.lit(not out)) for out in (False, True)]
    both = R.attach_dims(sides[0].unionByName(sides[1]), t, ["retailer"])
    out = both.groupBy("retailer", "in_set").agg(F.count(F.lit(1)).alias("n_stores"), F.sum("v").alias("ty_sales"))
    return M.as_double(out, ["ty_sales"])


ORACLE["stores_by_product_set"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), f"""sold AS (
  SELECT DISTINCT store FROM pos, a WHERE product = '{PRODUCT}' AND sale_date BETWEEN ys_ty AND ye_ty AND store IS NOT NULL),
per AS (SELECT store, retailer, sum(value) AS v FROM pos, a WHERE sale_date BETWEEN e_ty - {_NW} AND e_ty AND store IS NOT NULL GROUP BY store, retailer)""") + f"""
SELECT retailer, store IN (SELECT store FROM sold) AS in_set, count(*) AS n_stores, {S.dbl('sum(v)')} AS ty_sales
FROM per GROUP BY 1, 2"""


@query("sole_product_of_store_day")
def sole_product_of_store_day(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Every store and day of this year's N weeks as a context: whether one product alone is
    in it, that product (else blank), and its sales."""
    t = Tables(spark, sf_dir)
    lines = R.attach_dims(R.sales_lines(t, M.weekly_window(sel, N_WEEKS)), t, ["product"])
    out = lines.groupBy("store", "sale_date").agg(B.selected_value(F.col("product")).alias("product"), F.sum("value").alias("sales"))
    return M.as_double(out.withColumn("one_product", F.col("product").isNotNull()), ["sales"])


ORACLE["sole_product_of_store_day"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte()) + f"""
SELECT store, sale_date, CASE WHEN count(DISTINCT product) = 1 THEN min(product) END AS product,
       count(DISTINCT product) = 1 AS one_product, {S.dbl('sum(value)')} AS sales
FROM pos, a WHERE sale_date BETWEEN e_ty - {_NW} AND e_ty GROUP BY store, sale_date"""
