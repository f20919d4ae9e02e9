"""The All / Filtered stores toggle over every measure of both facts, the
category fact's load, and the metric catalogue of the week parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import blanks as B
from ..operators import measures as M
from ..operators.rank import level_rank
from ..operators.report import metric_order, store_toggle_rows
from ..sources import retail as R
from ..sources.tables import Tables
from . import sqlkit as S
from .feeds import _RO_SQL, EXCLUDED_RETAILERS
from .registry import query
from .retail import N_WEEKS, SEL, _anchor_cte, _with
from .retail_more import _NW

# (prefix, TY, LY, % rule) of the toggled measures.
POS_MEASURES = (("wk", "weekly"), ("ytd", "ytd"), ("mtd", "mtd"))
CATEGORY_MEASURES = (("mtd", "mtd"), ("ytd", "ytd"))


def _with_all(df: DataFrame, measures) -> DataFrame:
    for prefix, pct in measures:
        df = M.with_change(df, f"{prefix}_ty", f"{prefix}_ly", prefix, pct=pct)
        df = df.withColumn(f"{prefix}_trend", B.sign_class(F.col(f"{prefix}_pct")))
    return M.as_double(df, [f"{p}_{y}" for p, _ in measures for y in ("ty", "ly")])


def _measures_sql(measures) -> str:
    rule = {"weekly": S.weekly_pct, "ytd": S.ytd_pct, "mtd": S.abs_ratio_pct}
    out = []
    for p, pct in measures:
        ty, ly = f"{p}_ty", f"{p}_ly"
        out += [f"{S.dbl(ty)} AS {ty}", f"{S.dbl(ly)} AS {ly}", f"{S.dbl(S.blank_sub(ty, ly))} AS {p}_change",
                f"{rule[pct](ty, ly)} AS {p}_pct", f"{S.sign(rule[pct](ty, ly))} AS {p}_trend"]
    return ", ".join(out)


def _toggle_sql(per_store: str, measures, key: str = "store") -> str:
    """``per_store``: CTE body giving retailer, store and the measures' sums."""
    cols = [f"{p}_{y}" for p, _ in measures for y in ("ty", "ly")]
    total = ", ".join(f"sum({c}) AS {c}" for c in cols)
    return (f"ps AS ({per_store}), tot AS (SELECT retailer, {total} FROM ps GROUP BY retailer), "
            f"both_ AS (SELECT ps.retailer, ps.{key}, 'All Stores' AS custom_total, {', '.join('tot.' + c for c in cols)} "
            f"FROM ps JOIN tot ON ps.retailer IS NOT DISTINCT FROM tot.retailer "
            f"UNION ALL SELECT retailer, {key}, 'Filtered Stores', {', '.join(cols)} FROM ps) "
            f"SELECT retailer, {key}, custom_total, {_measures_sql(measures)} FROM both_")


_LAST_LY = """b AS (SELECT *, CASE WHEN last_d = last_day(last_d) THEN last_day(CAST(last_d - INTERVAL 12 MONTH AS DATE))
       ELSE CAST(last_d - INTERVAL 12 MONTH AS DATE) END AS last_ly FROM a)"""


@query("store_total_toggle_all", _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), _LAST_LY) + ", " + _toggle_sql(f"""
  SELECT retailer, store,
         sum(value) FILTER (WHERE sale_date BETWEEN e_ty - {_NW} AND e_ty) AS wk_ty,
         sum(value) FILTER (WHERE sale_date BETWEEN e_ly - {_NW} AND e_ly) AS wk_ly,
         sum(value) FILTER (WHERE sale_date BETWEEN ys_ty AND ye_ty) AS ytd_ty,
         sum(value) FILTER (WHERE sale_date BETWEEN ys_ly AND ye_ly) AS ytd_ly,
         sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('month', last_d) AND last_d) AS mtd_ty,
         sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('month', last_ly) AND last_ly) AS mtd_ly
  FROM pos, b WHERE sale_date BETWEEN least(ys_ly, e_ly - {_NW}, date_trunc('month', last_ly)) AND greatest(ye_ty, e_ty, last_d)
  GROUP BY retailer, store""", POS_MEASURES))
def store_total_toggle_all(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Weekly, YTD and MTD sales, $ and % change and trend per store, as
    filtered and with the store filter removed."""
    t = Tables(spark, sf_dir)
    wins = {"wk_ty": M.weekly_window(sel, N_WEEKS), "wk_ly": M.weekly_window(sel, N_WEEKS, last_year=True),
            "ytd_ty": M.ytd_window(sel), "ytd_ly": M.ytd_window(sel, last_year=True),
            "mtd_ty": M.mtd_window(sel), "mtd_ly": M.mtd_window(sel, last_year=True)}
    per_store = M.window_sums(t, wins, ["retailer", "store"])
    return _with_all(store_toggle_rows(per_store, "retailer", "store", list(wins)), POS_MEASURES)


# ------------------------------------------------------------ category fact

_CAT_KEYED = f"""{_RO_SQL}, ck AS (
  SELECT o.o_custkey AS store, CAST(o.o_orderdate AS DATE) AS sale_date, CAST(o.o_totalprice AS DECIMAL(18,2)) AS value,
         r.r_name AS retailer,
         nullif(coalesce(CAST(o.o_custkey AS VARCHAR), '') || coalesce(CAST(ro.retailer_order AS VARCHAR), ''), '') AS join_key
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey LEFT JOIN ro ON ro.retailer = r.r_name)"""


def category_keyed(t: Tables, pre: DataFrame) -> DataFrame:
    """Category rows (one per store) with their retailer, its order (unknown
    retailers keep none) and the text join key: store digits ++ order, parts
    that are missing left out."""
    df = R.join_dim(pre, R.category_store_dim(t), "store")
    order = R.retailer_order(t, EXCLUDED_RETAILERS)                # five rows
    df = df.join(F.broadcast(order), "retailer", "left")
    key = F.nullif(F.concat_ws("", F.col("store").cast("string"), F.col("retailer_order").cast("string")), F.lit(""))
    return df.withColumn("join_key", key)


@query("category_fact_load", f"""WITH {_CAT_KEYED}
SELECT retailer, count(*) AS n_rows, CAST(sum(value) AS DOUBLE) AS sales, count(DISTINCT join_key) AS n_keys,
       min(join_key) AS min_key, max(join_key) AS max_key FROM ck GROUP BY retailer""")
def category_fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category feed left-joined to the retailer order and keyed as text,
    summarised per retailer."""
    t = Tables(spark, sf_dir)
    pre = R.category_lines(t).groupBy("store").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    keyed = category_keyed(t, pre)
    per_key = keyed.groupBy("retailer", "join_key").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    return per_key.groupBy("retailer").agg(
        F.sum("n").cast("long").alias("n_rows"), F.sum("v").cast("double").alias("sales"),
        F.count("join_key").alias("n_keys"), F.min("join_key").alias("min_key"), F.max("join_key").alias("max_key"))


@query("category_total_toggle", _with(S.calendar_cte(), _anchor_cte(), _LAST_LY, _CAT_KEYED) + ", " + _toggle_sql("""
  SELECT retailer, join_key,
         sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('month', last_d) AND last_d) AS mtd_ty,
         sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('month', last_ly) AND last_ly) AS mtd_ly,
         sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('year', last_d) AND last_d) AS ytd_ty,
         sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('year', last_ly) AND last_ly) AS ytd_ly
  FROM ck, b WHERE sale_date BETWEEN date_trunc('year', last_ly) AND last_d GROUP BY retailer, join_key""", CATEGORY_MEASURES, "join_key"))
def category_total_toggle(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """The category fact by store (through its join key, which is what a store
    filter reaches it by) and with the store filter removed: MTD and YTD
    sales, $ and % change and trend."""
    t = Tables(spark, sf_dir)
    wins = {"mtd_ty": M.mtd_window(sel), "mtd_ly": M.mtd_window(sel, last_year=True),
            "ytd_ty": M.calendar_ytd_window(sel), "ytd_ly": M.calendar_ytd_window(sel, last_year=True)}
    pre = R.category_lines(t, M.envelope(wins.values())).groupBy("store").agg(*M._cond_sums(wins))
    per_store = category_keyed(t, pre).groupBy("retailer", "join_key").agg(*[F.sum(c).alias(c) for c in wins])
    return _with_all(store_toggle_rows(per_store, "retailer", "join_key", list(wins)), CATEGORY_MEASURES)


@query("product_mtd_ly", _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), _LAST_LY) + """
SELECT retailer, product, CAST(sum(value) AS DOUBLE) AS mtd_ly FROM pos, b
WHERE sale_date BETWEEN date_trunc('month', last_ly) AND last_ly GROUP BY retailer, product""")
def product_mtd_ly(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Last year's month-to-date sales of every product by retailer."""
    df = M.window_sums(Tables(spark, sf_dir), {"mtd_ly": M.mtd_window(sel, last_year=True)}, ["retailer", "product"])
    return M.as_double(df, ["mtd_ly"])


# ---------------------------------------------------------- metric catalogue

# The eleven metrics that the week parameter offers for each of
# its windows (label, with {n} for the window's weeks; column; category), in order.
CATALOGUE = (("SSR Name", "ssr_name", "SSR Name"), ("YTD % Chg Rank", "ytd_rank", "YTD % Chg Rank"),
             ("Store Count", "store_count", "Store Count"), ("TTL L{n}W Sales TY", "ty", "Weekly"),
             ("TTL L{n}W Sales LY", "ly", "Weekly"), ("$ Change L{n}W", "change", "Weekly"), ("% Change L{n}W", "pct", "Weekly"),
             ("TTL YTD Sales TY", "ytd_ty", "YTD"), ("TTL YTD Sales LY", "ytd_ly", "YTD"),
             ("$ Change YTD", "ytd_change", "YTD"), ("% Change YTD", "ytd_pct", "YTD"))
# The SSR report's own parameter: label, category, order (joined many-to-many by category).
SSR_PARAMETER = (("SSR Name", "SSR Name", 0), ("YTD % Chg Rank", "YTD % Chg Rank", 1), ("Store Count", "Store Count", 2),
                 ("TTL Weekly Sales TY", "Weekly", 3), ("TTL Weekly sales LY", "Weekly", 4), ("$ Change Weekly", "Weekly", 5),
                 ("% Change Weekly", "Weekly", 6), ("TTL YTD Sales TY", "YTD", 7), ("TTL YTD sales LY", "YTD", 8),
                 ("$ Change YTD", "YTD", 9), ("% Change YTD", "YTD", 10))


def catalogue_rows() -> list[tuple]:
    """(label, column, category, weeks, order) of every window's metrics."""
    out = []
    for n in M.WEEK_CHOICES:
        for label, col, cat in CATALOGUE:
            out.append((label.format(n=n), col, cat, n, len(out) + 1))
    return out


def _catalogue_report(spark: SparkSession, t: Tables, sel: M.Selection) -> DataFrame:
    wins = {"ytd_ty": M.ytd_window(sel), "ytd_ly": M.ytd_window(sel, last_year=True)}
    for n in M.WEEK_CHOICES:
        wins |= {f"ty_{n}": M.weekly_window(sel, n), f"ly_{n}": M.weekly_window(sel, n, last_year=True)}
    per_store = M.window_sums(t, wins, ["ssr", "store"])
    wide = per_store.groupBy("ssr").agg(*[F.sum(c).alias(c) for c in wins], B.distinct_with_blank(F.col("store")).alias("store_count"))
    wide = M.with_change(wide, "ytd_ty", "ytd_ly", "ytd", pct="ytd")
    wide = level_rank(level_rank(wide, "ytd_ty", "_by_ty"), "ytd_pct", "_by_pct")
    wide = wide.withColumn("ytd_rank", F.when(F.col("ytd_ly").isNull(), F.col("_by_ty")).otherwise(F.col("_by_pct")))
    rows = []
    for label, col, cat, n, order in catalogue_rows():
        weekly = {"ty": F.col(f"ty_{n}"), "ly": F.col(f"ly_{n}"), "change": B.blank_sub(F.col(f"ty_{n}"), F.col(f"ly_{n}")),
                  "pct": B.weekly_pct_change(F.col(f"ty_{n}"), F.col(f"ly_{n}"))}
        value = F.lit(None) if col == "ssr_name" else weekly.get(col, F.col(col) if col not in weekly else None)
        rows.append(F.struct(F.lit(label).alias("metric"), F.lit(cat).alias("category"), F.lit(order).alias("metric_ord"),
                             value.cast("double").alias("value"), (F.col("ssr") if col == "ssr_name" else F.lit(None).cast("string")).alias("text_value")))
    long = wide.select("ssr", F.explode(F.array(*rows)).alias("m")).select("ssr", "m.*")
    return long.withColumn("window_key", metric_order(F.col("metric_ord"), len(CATALOGUE), [s for _, s, _ in _WEEK_SORT]))


# Weeks, sort key and label of the windows that the catalogue has (sort key 5 is unused).
_WEEK_SORT = ((1, 1, "1 Week"), (4, 2, "4 Weeks"), (13, 3, "13 Weeks"), (26, 4, "26 Weeks"), (52, 6, "52 Weeks"))


def _catalogue_sql() -> str:
    sums = ", ".join(f"sum(value) FILTER (WHERE sale_date BETWEEN e_ty - {7 * n - 1} AND e_ty) AS ty_{n}, "
                     f"sum(value) FILTER (WHERE sale_date BETWEEN e_ly - {7 * n - 1} AND e_ly) AS ly_{n}" for n in M.WEEK_CHOICES)
    wide = f"""w0 AS (SELECT ssr, {sums}, sum(value) FILTER (WHERE sale_date BETWEEN ys_ty AND ye_ty) AS ytd_ty,
      sum(value) FILTER (WHERE sale_date BETWEEN ys_ly AND ye_ly) AS ytd_ly,
      count(DISTINCT store) + max(CASE WHEN store IS NULL THEN 1 ELSE 0 END) AS store_count
      FROM pos, a WHERE sale_date BETWEEN least(ys_ly, e_ly - 363) AND greatest(ye_ty, e_ty) GROUP BY ssr),
w1 AS (SELECT *, {S.ytd_pct('ytd_ty', 'ytd_ly')} AS ytd_pct FROM w0),
w AS (SELECT *, CASE WHEN ytd_ly IS NULL THEN CASE WHEN ytd_ty IS NOT NULL THEN dense_rank() OVER (ORDER BY ytd_ty DESC NULLS LAST) END
      ELSE dense_rank() OVER (ORDER BY ytd_pct DESC NULLS LAST) END AS ytd_rank FROM w1)"""
    rows, key = [], {n: s for n, s, _ in _WEEK_SORT}
    for label, col, cat, n, order in catalogue_rows():
        ty, ly = f"ty_{n}", f"ly_{n}"
        value = {"ssr_name": "NULL", "ty": ty, "ly": ly, "change": S.blank_sub(ty, ly), "pct": S.weekly_pct(ty, ly),
                 "ytd_change": S.blank_sub("ytd_ty", "ytd_ly")}.get(col, col)
        text = "ssr" if col == "ssr_name" else "CAST(NULL AS VARCHAR)"
        rows.append(f"SELECT ssr, '{label}' AS metric, '{cat}' AS category, CAST({order} AS INTEGER) AS metric_ord, "
                    f"CAST({value} AS DOUBLE) AS value, {text} AS text_value, CAST({key[n]} AS BIGINT) AS window_key FROM w")
    weeks = ", ".join(f"({n}, {s}, '{x}')" for n, s, x in _WEEK_SORT)
    return _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), wide, f"l AS ({' UNION ALL '.join(rows)})",
                 f"wt(weeks, sort, label) AS (VALUES {weeks})")


@query("metric_catalogue_report", _catalogue_sql() + """
SELECT ssr, metric, category, metric_ord, window_key, CAST(weeks AS BIGINT) AS weeks, label AS window_label, value, text_value
FROM l JOIN wt ON wt.sort = l.window_key""")
def metric_catalogue_report(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """All eleven metrics of all five week windows per SSR, as rows with their
    order, category and window: the order's bucket is the window key, which
    the week table is joined on."""
    t = Tables(spark, sf_dir)
    weeks = R.week_windows(spark).select(F.col("sort").alias("window_key"), "weeks", F.col("label").alias("window_label"))
    out = _catalogue_report(spark, t, sel).join(F.broadcast(weeks), "window_key")      # seven rows
    return out.select("ssr", "metric", "category", "metric_ord", "window_key", "weeks", "window_label", "value", "text_value")


_PARAM_VALUES = ", ".join(f"('{p}', '{c}', {o})" for p, c, o in SSR_PARAMETER)


@query("ssr_parameter_metrics", _catalogue_sql() + f""", pr(parameter, category, parameter_ord) AS (VALUES {_PARAM_VALUES})
SELECT pr.parameter, CAST(pr.parameter_ord AS INTEGER) AS parameter_ord, l.category, l.window_key, count(DISTINCT l.metric) AS n_metrics,
       count(l.value) AS n_values, CAST(sum(l.value) AS DOUBLE) AS value_sum
FROM pr JOIN l ON l.category = pr.category GROUP BY ALL""")
def ssr_parameter_metrics(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """The SSR report's parameter against the week parameter's metrics: both
    sides repeat a category (many-to-many), so the metric rows are summed per
    category and window before the two code tables meet."""
    t = Tables(spark, sf_dir)
    per = _catalogue_report(spark, t, sel).groupBy("category", "window_key").agg(
        F.count_distinct("metric").alias("n_metrics"), F.count("value").alias("n_values"), F.sum("value").alias("value_sum"))
    parameter = spark.createDataFrame(list(SSR_PARAMETER), "parameter string, category string, parameter_ord int")
    return per.join(F.broadcast(parameter), "category").select(                         # eleven rows
        "parameter", "parameter_ord", "category", "window_key", "n_metrics", "n_values", "value_sum")


# Choice rows of the MTD and YTD pickers (label, window, measure).
PICKERS = ((" MTD LY ", "MTD", "wk_ly"), (" MTD TY ", "MTD", "wk_ty"), ("$ Change ", "MTD", "wk_change"),
           (" YTD LY ", "YTD", "ytd_ly"), (" YTD TY ", "YTD", "ytd_ty"), ("$ Change ", "YTD", "ytd_change"))


def _picker_sql() -> str:
    value = {"wk_ly": "wk_ly", "wk_ty": "wk_ty", "wk_change": S.blank_sub("wk_ty", "wk_ly"), "ytd_ly": "ytd_ly", "ytd_ty": "ytd_ty",
             "ytd_change": S.blank_sub("ytd_ty", "ytd_ly")}
    rows = " UNION ALL ".join(
        f"SELECT retailer, '{w}' AS picker, '{l}' AS label, CAST({1 + i % 3} AS INTEGER) AS label_order, CAST({value[m]} AS DOUBLE) AS value FROM g"
        for i, (l, w, m) in enumerate(PICKERS))
    return _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), f"""g AS (SELECT retailer,
    sum(value) FILTER (WHERE sale_date BETWEEN e_ty - {_NW} AND e_ty) AS wk_ty, sum(value) FILTER (WHERE sale_date BETWEEN e_ly - {_NW} AND e_ly) AS wk_ly,
    sum(value) FILTER (WHERE sale_date BETWEEN ys_ty AND ye_ty) AS ytd_ty, sum(value) FILTER (WHERE sale_date BETWEEN ys_ly AND ye_ly) AS ytd_ly
  FROM pos, a WHERE sale_date BETWEEN least(ys_ly, e_ly - {_NW}) AND greatest(ye_ty, e_ty) GROUP BY retailer)""") + rows


@query("picker_metrics", _picker_sql())
def picker_metrics(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """The MTD and YTD pickers: last year, this year and the change per
    retailer, in the order that their labels give."""
    wins = {"wk_ty": M.weekly_window(sel, N_WEEKS), "wk_ly": M.weekly_window(sel, N_WEEKS, last_year=True),
            "ytd_ty": M.ytd_window(sel), "ytd_ly": M.ytd_window(sel, last_year=True)}
    df = M.window_sums(Tables(spark, sf_dir), wins, ["retailer"])
    df = M.with_change(M.with_change(df, "wk_ty", "wk_ly", "wk"), "ytd_ty", "ytd_ly", "ytd", pct="ytd")
    rows = [F.struct(F.lit(w).alias("picker"), F.lit(l).alias("label"), F.col(m).cast("double").alias("value")) for l, w, m in PICKERS]
    long = df.select("retailer", F.explode(F.array(*rows)).alias("r")).select("retailer", "r.*")
    label = F.trim("label")
    order = F.when(label.endswith("LY"), 1).when(label.endswith("TY"), 2).when(label == "$ Change", 3).cast("int")
    return long.withColumn("label_order", order)
