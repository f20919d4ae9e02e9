"""Retail time-window queries (this-year / last-year sales families).

The report selection used by every registered query: year 2000, week 40,
four weeks, thirteen months.  Each Spark plan evaluates all of its windows
in one pass over the POS fact (see ``operators.measures``); each oracle
re-derives the calendar and the window bounds in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import blanks as B
from ..operators import measures as M
from ..operators.report import long_metric_report
from ..sources import retail as R
from ..sources.tables import Tables
from . import sqlkit as S
from .registry import query

SEL = M.Selection(2000, 40)
N_WEEKS = 4
N_MONTHS = 13
Y, W = SEL.year, SEL.week


def _anchor_cte(Y: int = Y, W: int = W) -> str:
    """Window bounds derived in SQL from the calendar."""
    return f"""a AS (SELECT
      max(we) FILTER (WHERE y = {Y} AND wk = {W}) AS e_ty,
      max(we) FILTER (WHERE y = {Y - 1} AND wk = {W}) AS e_ly,
      max(d) FILTER (WHERE y = {Y} AND wk = {W}) AS last_d,
      min(d) FILTER (WHERE y = {Y} AND wk = {W}) AS first_d,
      min(d) FILTER (WHERE y = {Y} AND wk <= {W}) AS ys_ty, max(d) FILTER (WHERE y = {Y} AND wk <= {W}) AS ye_ty,
      min(d) FILTER (WHERE y = {Y - 1} AND wk <= {W}) AS ys_ly, max(d) FILTER (WHERE y = {Y - 1} AND wk <= {W}) AS ye_ly
    FROM cal)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --------------------------------------------------------------- flagship

def nweek_ty_ly_by_retailer(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL,
                            n_weeks: int = N_WEEKS) -> DataFrame:
    """N-week sales this year and last year by retailer, with the $ change and
    the weekly % change (the flagship)."""
    t = Tables(spark, sf_dir)
    wins = {"ty_sales": M.weekly_window(sel, n_weeks), "ly_sales": M.weekly_window(sel, n_weeks, last_year=True)}
    df = M.window_sums(t, wins, ["retailer"])
    df = M.with_change(df, "ty_sales", "ly_sales", "wk", pct="weekly")
    return M.as_double(df, ["ty_sales", "ly_sales"])


_NW = 7 * N_WEEKS - 1


def nweek_sql(y: int = Y, w: int = W, n: int = N_WEEKS) -> str:
    """Oracle of the N-week TY/LY report for any selection (9999 = YTD;
    other N outside the week choices give BLANK windows)."""
    if n == 9999:
        (tlo, thi), (llo, lhi) = ("ys_ty", "ye_ty"), ("ys_ly", "ye_ly")
    elif n in M.WEEK_CHOICES:
        (tlo, thi), (llo, lhi) = (f"e_ty - {7 * n - 1}", "e_ty"), (f"e_ly - {7 * n - 1}", "e_ly")
    else:
        (tlo, thi), (llo, lhi) = ("NULL", "NULL"), ("NULL", "NULL")
    # The scan envelope (least start .. greatest end) decides which groups exist.
    return _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(y, w), f"""agg AS (
  SELECT retailer,
         sum(value) FILTER (WHERE sale_date BETWEEN {tlo} AND {thi}) AS ty,
         sum(value) FILTER (WHERE sale_date BETWEEN {llo} AND {lhi}) AS ly
  FROM pos, a WHERE sale_date BETWEEN least({tlo}, {llo}) AND greatest({thi}, {lhi}) GROUP BY retailer)""") + f"""
SELECT retailer, {S.dbl('ty')} AS ty_sales, {S.dbl('ly')} AS ly_sales,
       {S.dbl(S.blank_sub('ty', 'ly'))} AS wk_change, {S.weekly_pct('ty', 'ly')} AS wk_pct
FROM agg"""


NWEEK_SQL = nweek_sql()

query("nweek_ty_ly_by_retailer", NWEEK_SQL)(nweek_ty_ly_by_retailer)


# ------------------------------------------------ all windows, long format

WINDOW_KEYS = [(1, 1, "1 Week"), (4, 2, "4 Weeks"), (13, 3, "13 Weeks"), (26, 4, "26 Weeks"),
               (52, 6, "52 Weeks"), (9999, 7, "YTD")]
# Fixed metric catalogue of the long report: (label, column, order, category).
METRICS = [("TY Sales", "ty_sales", 1, "Sales"), ("LY Sales", "ly_sales", 2, "Sales"),
           ("$ Change", "wk_change", 3, "Change"), ("% Change", "wk_pct", 4, "Change")]


@query("nweek_all_windows_long")
def nweek_all_windows_long(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Every week window (1, 4, 13, 26, 52 weeks, YTD) x every metric, as
    labelled long rows sorted for display."""
    t = Tables(spark, sf_dir)
    wins = {}
    for n, _, _ in WINDOW_KEYS:
        wins[f"ty_{n}"] = M.weekly_window(sel, n)
        wins[f"ly_{n}"] = M.weekly_window(sel, n, last_year=True)
    wide = M.window_sums(t, wins, ["retailer"])
    per_window = wide.select("retailer", F.explode(F.array(*[
        F.struct(F.lit(n).cast("long").alias("weeks"), F.col(f"ty_{n}").alias("ty_sales"),
                 F.col(f"ly_{n}").alias("ly_sales")) for n, _, _ in WINDOW_KEYS])).alias("w")
    ).select("retailer", "w.*")
    per_window = M.as_double(M.with_change(per_window, "ty_sales", "ly_sales", "wk"), ["ty_sales", "ly_sales"])
    return long_metric_report(spark, per_window, ["retailer", "weeks"], METRICS, R.week_windows(spark),
                              window_key="weeks")


def _long_sql() -> str:
    parts = []
    for n, sort, label in WINDOW_KEYS:
        if n == 9999:
            ty_rng, ly_rng = "ys_ty AND ye_ty", "ys_ly AND ye_ly"
        else:
            ty_rng, ly_rng = f"e_ty - {7 * n - 1} AND e_ty", f"e_ly - {7 * n - 1} AND e_ly"
        parts.append(f"sum(value) FILTER (WHERE sale_date BETWEEN {ty_rng}) AS ty_{n}, "
                     f"sum(value) FILTER (WHERE sale_date BETWEEN {ly_rng}) AS ly_{n}")
    env_lo = "least(e_ly - 363, ys_ly)"
    env_hi = "greatest(e_ty, ye_ty)"
    wide = (f"wide AS (SELECT retailer, {', '.join(parts)} FROM pos, a "
            f"WHERE sale_date BETWEEN {env_lo} AND {env_hi} GROUP BY retailer)")
    rows = []
    for n, sort, label in WINDOW_KEYS:
        ty, ly = f"ty_{n}", f"ly_{n}"
        vals = {"ty_sales": S.dbl(ty), "ly_sales": S.dbl(ly), "wk_change": S.dbl(S.blank_sub(ty, ly)),
                "wk_pct": S.weekly_pct(ty, ly)}
        for mlabel, mcol, mord, mcat in METRICS:
            rows.append(f"SELECT retailer, CAST({n} AS BIGINT) AS weeks, '{label}' AS window_label, "
                        f"CAST({sort} AS BIGINT) AS window_sort, '{mlabel}' AS metric, CAST({mord} AS INTEGER) AS metric_ord, "
                        f"'{mcat}' AS category, {vals[mcol]} AS value FROM wide")
    return _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), wide) + "\nUNION ALL\n".join(rows)


from .registry import ORACLE as _ORACLE  # noqa: E402
_ORACLE["nweek_all_windows_long"] = _long_sql()


# ------------------------------------------------------------ YTD by product

@query("ytd_ty_ly_by_product")
def ytd_ty_ly_by_product(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Year-to-week sales TY and LY by product, with $ and % change (0 when LY
    is blank)."""
    t = Tables(spark, sf_dir)
    wins = {"ytd_ty": M.ytd_window(sel), "ytd_ly": M.ytd_window(sel, last_year=True)}
    df = M.with_change(M.window_sums(t, wins, ["product"]), "ytd_ty", "ytd_ly", "ytd", pct="ytd")
    return M.as_double(df, ["ytd_ty", "ytd_ly"])


_ORACLE["ytd_ty_ly_by_product"] = _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(), """agg AS (
  SELECT product,
         sum(value) FILTER (WHERE sale_date BETWEEN ys_ty AND ye_ty) AS ty,
         sum(value) FILTER (WHERE sale_date BETWEEN ys_ly AND ye_ly) AS ly
  FROM pos, a WHERE sale_date BETWEEN ys_ly AND ye_ty GROUP BY product)""") + f"""
SELECT product, {S.dbl('ty')} AS ytd_ty, {S.dbl('ly')} AS ytd_ly,
       {S.dbl(S.blank_sub('ty', 'ly'))} AS ytd_change, {S.ytd_pct('ty', 'ly')} AS ytd_pct FROM agg"""


# ------------------------------------------------ calendar MTD / YTD with LY

@query("mtd_ytd_calendar_ly")
def mtd_ytd_calendar_ly(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Calendar month-to-date and year-to-date sales with their
    same-period-last-year values by retailer."""
    t = Tables(spark, sf_dir)
    wins = {"mtd_ty": M.mtd_window(sel), "mtd_ly": M.mtd_window(sel, last_year=True),
            "cytd_ty": M.calendar_ytd_window(sel), "cytd_ly": M.calendar_ytd_window(sel, last_year=True)}
    df = M.window_sums(t, wins, ["retailer"])
    df = M.with_change(df, "mtd_ty", "mtd_ly", "mtd", pct="mtd")
    df = M.with_change(df, "cytd_ty", "cytd_ly", "cytd", pct="ytd")
    return M.as_double(df, list(wins))


def mtd_ytd_sql(y: int = Y, w: int = W) -> str:
    return _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(y, w), """b AS (
      SELECT last_d, CASE WHEN last_d = last_day(last_d) THEN last_day(CAST(last_d - INTERVAL 12 MONTH AS DATE)) ELSE CAST(last_d - INTERVAL 12 MONTH AS DATE) END AS last_ly FROM a),
    agg AS (
      SELECT retailer,
        sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('month', last_d) AND last_d) AS mtd_ty,
        sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('month', last_ly) AND last_ly) AS mtd_ly,
        sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('year', last_d) AND last_d) AS cytd_ty,
        sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('year', last_ly) AND last_ly) AS cytd_ly
      FROM pos, b WHERE sale_date BETWEEN date_trunc('year', last_ly) AND last_d GROUP BY retailer)""") + f"""
    SELECT retailer, {S.dbl('mtd_ty')} AS mtd_ty, {S.dbl('mtd_ly')} AS mtd_ly, {S.dbl('cytd_ty')} AS cytd_ty,
           {S.dbl('cytd_ly')} AS cytd_ly, {S.dbl(S.blank_sub('mtd_ty', 'mtd_ly'))} AS mtd_change,
           {S.abs_ratio_pct('mtd_ty', 'mtd_ly')} AS mtd_pct, {S.dbl(S.blank_sub('cytd_ty', 'cytd_ly'))} AS cytd_change,
           {S.ytd_pct('cytd_ty', 'cytd_ly')} AS cytd_pct FROM agg"""


_ORACLE["mtd_ytd_calendar_ly"] = mtd_ytd_sql()


# ----------------------------------------------------- category fact change

@query("category_change")
def category_change(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Category-fact MTD / YTD sales, LY values, $ and % change by market
    segment."""
    t = Tables(spark, sf_dir)
    wins = {"mtd_ty": M.mtd_window(sel), "mtd_ly": M.mtd_window(sel, last_year=True),
            "ytd_ty": M.calendar_ytd_window(sel), "ytd_ly": M.calendar_ytd_window(sel, last_year=True)}
    df = M.category_window_sums(t, wins)
    df = M.with_change(df, "mtd_ty", "mtd_ly", "mtd", pct="mtd")
    df = M.with_change(df, "ytd_ty", "ytd_ly", "ytd", pct="ytd")
    return M.as_double(df, list(wins))


_CAT_CAL = S.calendar_cte("(SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem)",
                          "(SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem)")
def category_change_sql(y: int = Y, w: int = W) -> str:
    return _with(_CAT_CAL, S.CATEGORY_FACT_CTE, _anchor_cte(y, w), """b AS (
      SELECT last_d, CASE WHEN last_d = last_day(last_d) THEN last_day(CAST(last_d - INTERVAL 12 MONTH AS DATE)) ELSE CAST(last_d - INTERVAL 12 MONTH AS DATE) END AS last_ly FROM a),
    agg AS (
      SELECT category,
        sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('month', last_d) AND last_d) AS mtd_ty,
        sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('month', last_ly) AND last_ly) AS mtd_ly,
        sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('year', last_d) AND last_d) AS ytd_ty,
        sum(value) FILTER (WHERE sale_date BETWEEN date_trunc('year', last_ly) AND last_ly) AS ytd_ly
      FROM cat, b WHERE sale_date BETWEEN date_trunc('year', last_ly) AND last_d GROUP BY category)""") + f"""
    SELECT category, {S.dbl('mtd_ty')} AS mtd_ty, {S.dbl('mtd_ly')} AS mtd_ly, {S.dbl('ytd_ty')} AS ytd_ty,
           {S.dbl('ytd_ly')} AS ytd_ly, {S.dbl(S.blank_sub('mtd_ty', 'mtd_ly'))} AS mtd_change,
           {S.abs_ratio_pct('mtd_ty', 'mtd_ly')} AS mtd_pct, {S.dbl(S.blank_sub('ytd_ty', 'ytd_ly'))} AS ytd_change,
           {S.ytd_pct('ytd_ty', 'ytd_ly')} AS ytd_pct FROM agg"""


_ORACLE["category_change"] = category_change_sql()


# ------------------------------------------------ last / prior N months

@query("last_prior_n_months")
def last_prior_n_months(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL,
                        n_months: int = N_MONTHS) -> DataFrame:
    """Sales in the last N months and in the same N months a year earlier, with
    % change, by retailer and SSR."""
    t = Tables(spark, sf_dir)
    wins = {"last_n": M.last_n_months_window(sel, n_months), "prior_n": M.prior_n_months_window(sel, n_months)}
    df = M.window_sums(t, wins, ["retailer", "ssr"])
    df = df.withColumn("n_pct", B.ratio_change(F.col("last_n"), F.col("prior_n")))
    return M.as_double(df, list(wins))


def last_prior_sql(y: int = Y, w: int = W) -> str:
    return _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(y, w), f"""b AS (
      SELECT last_d, date_trunc('month', last_d - INTERVAL {N_MONTHS - 1} MONTH) AS l_start,
             CAST(last_d - INTERVAL 12 MONTH AS DATE) AS p_end,
             date_trunc('month', last_d - INTERVAL {12 + N_MONTHS - 1} MONTH) AS p_start FROM a),
    agg AS (
      SELECT retailer, ssr,
        sum(value) FILTER (WHERE sale_date BETWEEN l_start AND last_d) AS last_n,
        sum(value) FILTER (WHERE sale_date BETWEEN p_start AND p_end) AS prior_n
      FROM pos, b WHERE sale_date BETWEEN p_start AND last_d GROUP BY retailer, ssr)""") + f"""
    SELECT retailer, ssr, {S.dbl('last_n')} AS last_n, {S.dbl('prior_n')} AS prior_n,
           {S.ratio_pct('last_n', 'prior_n')} AS n_pct FROM agg"""


_ORACLE["last_prior_n_months"] = last_prior_sql()


# ------------------------------------- week-ending / prior / last-days / 7d

@query("alt_week_windows")
def alt_week_windows(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL,
                     n_weeks: int = N_WEEKS) -> DataFrame:
    """The week-ending, prior-N-weeks, last-7N-days and rolling-7-day windows
    by retailer."""
    t = Tables(spark, sf_dir)
    wins = {"we_last_n": M.week_ending_window(sel, n_weeks), "prior_n_weeks": M.prior_n_weeks_window(sel, n_weeks),
            "last_n_days": M.last_n_days_window(sel, n_weeks), "rolling_7d": M.rolling_7d_window(sel)}
    df = M.window_sums(t, wins, ["retailer"])
    df = df.withColumn("we_pct", B.weekly_pct_change(F.col("we_last_n"), F.col("prior_n_weeks")))
    return M.as_double(df, list(wins))


def alt_week_sql(y: int = Y, w: int = W) -> str:
    return _with(S.calendar_cte(), S.POS_FACT_CTE, _anchor_cte(y, w), f"""agg AS (
      SELECT p.retailer,
        sum(p.value) FILTER (WHERE c.we BETWEEN e_ty - {7 * N_WEEKS} AND e_ty) AS we_last_n,
        sum(p.value) FILTER (WHERE p.sale_date BETWEEN last_d - 365 - {7 * (N_WEEKS - 1)} AND last_d - 365) AS prior_n_weeks,
        sum(p.value) FILTER (WHERE p.sale_date BETWEEN last_d - {7 * N_WEEKS} AND last_d) AS last_n_days,
        sum(p.value) FILTER (WHERE p.sale_date BETWEEN last_d - 6 AND last_d) AS rolling_7d
      FROM pos p JOIN cal c ON c.d = p.sale_date, a
      WHERE p.sale_date BETWEEN least(e_ty - {7 * N_WEEKS + 6}, last_d - 365 - {7 * (N_WEEKS - 1)}) AND e_ty
      GROUP BY p.retailer)""") + f"""
    SELECT retailer, {S.dbl('we_last_n')} AS we_last_n, {S.dbl('prior_n_weeks')} AS prior_n_weeks,
           {S.dbl('last_n_days')} AS last_n_days, {S.dbl('rolling_7d')} AS rolling_7d,
           {S.weekly_pct('we_last_n', 'prior_n_weeks')} AS we_pct FROM agg"""


_ORACLE["alt_week_windows"] = alt_week_sql()


# --------------------------------------------- Monday-aligned week family

@query("monday_week_windows")
def monday_week_windows(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """The Monday-aligned week windows (last year, the 13 weeks before, forward
    from the week, dispatch) by retailer."""
    t = Tables(spark, sf_dir)
    wins = {f"ly_{n}w": M.monday_ly_window(sel, n) for n in (1, 4, 26, 52)}
    wins["prev_13w"] = M.monday_prev13_window(sel)
    wins.update({f"fwd_{n}w": M.monday_forward_window(sel, n) for n in (1, 4, 13, 26, 52)})
    wins.update({f"dispatch_{order}": M.monday_dispatch_window(sel, order) for order in M.MONDAY_DISPATCH})
    df = M.window_sums(t, wins, ["retailer"])
    return M.as_double(df, list(wins))


def _monday_sql(y: int = Y, w: int = W) -> str:
    ws = f"(make_date({y}, 1, 1) + {7 * (w - 1)})"
    ws_ly = f"(make_date({y - 1}, 1, 1) + {7 * (w - 1)})"
    # isodow: Monday = 1 .. Sunday = 7
    st = f"CAST({ws} - CAST(isodow({ws}) - 1 AS INTEGER) AS DATE)"
    st_ly = f"CAST({ws_ly} - CAST(isodow({ws_ly}) - 1 AS INTEGER) AS DATE)"
    cols = []
    for n, off in ((1, 0), (4, 21), (26, 175), (52, 357)):
        guard = f"{w} <> 53 AND " if n == 1 else ""
        cols.append(f"sum(value) FILTER (WHERE {guard}sale_date BETWEEN sl - {off} AND sl + 6) AS ly_{n}w")
    cols.append("sum(value) FILTER (WHERE sale_date BETWEEN st - 91 AND st - 1) AS prev_13w")
    for n in (1, 4, 13, 26, 52):
        cols.append(f"sum(value) FILTER (WHERE {w} <> 53 AND sale_date BETWEEN st AND st + {7 * n - 1}) AS fwd_{n}w")
    names = ["ly_1w", "ly_4w", "ly_26w", "ly_52w", "prev_13w", "fwd_1w", "fwd_4w", "fwd_13w", "fwd_26w", "fwd_52w"]
    chosen = dict(enumerate(("ly_1w", "ly_4w", "prev_13w", "ly_26w", "ly_52w")))
    return (_with(S.POS_FACT_CTE, f"b AS (SELECT {st} AS st, {st_ly} AS sl)",
                  f"agg AS (SELECT retailer, {', '.join(cols)} FROM pos, b "
                  f"WHERE sale_date BETWEEN sl - 357 AND st + 363 GROUP BY retailer)")
            + "SELECT retailer, " + ", ".join([f"{S.dbl(c)} AS {c}" for c in names]
                                              + [f"{S.dbl(c)} AS dispatch_{o}" for o, c in chosen.items()]) + " FROM agg")


_ORACLE["monday_week_windows"] = _monday_sql()
