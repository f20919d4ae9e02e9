"""Retail queries over many windows at once: every anchor of a year from
cumulative sums, and distinct stores of every level from bitmaps."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions.calendar import DateRange
from ..operators import bitmaps as BM
from ..operators import cumulative as CU
from ..operators import lattice as LT
from ..operators import layout as LY
from ..operators import measures as M
from ..session import scratch_path
from ..sources import retail as R
from ..sources.tables import Tables
from . import sqlkit as S
from .registry import query
from .retail import SEL, _with

N_MONTHS = 13


def anchored_windows(year: int, n_months: int = N_MONTHS) -> list[tuple[int, str, int, DateRange]]:
    """(week, family, N, days) of every window family for every week of ``year``."""
    out = []
    first, last = _dt.date(year, 1, 1), _dt.date(year, 12, 31)
    for week in sorted({C.py_week_no(first + _dt.timedelta(days=i)) for i in range((last - first).days + 1)}):
        sel = M.Selection(year, week)
        for n in M.WEEK_CHOICES:
            out += [(week, "weeks_ty", n, M.weekly_window(sel, n)), (week, "weeks_ly", n, M.weekly_window(sel, n, last_year=True)),
                    (week, "week_ending", n, M.week_ending_window(sel, n)), (week, "prior_weeks", n, M.prior_n_weeks_window(sel, n)),
                    (week, "last_days", n, M.last_n_days_window(sel, n))]
        out += [(week, "ytd_ty", M.YTD_CHOICE, M.ytd_window(sel)), (week, "ytd_ly", M.YTD_CHOICE, M.ytd_window(sel, last_year=True)),
                (week, "months", n_months, M.last_n_months_window(sel, n_months)),
                (week, "prior_months", n_months, M.prior_n_months_window(sel, n_months)), (week, "rolling_7d", 1, M.rolling_7d_window(sel))]
    return out


def _anchored_sql(year: int, member: str) -> str:
    ns = ", ".join(f"({n})" for n in M.WEEK_CHOICES)
    back = N_MONTHS - 1
    return _with(S.POS_FACT_CTE, f"""days AS (SELECT d, CAST(year(d) AS INTEGER) AS y, {S.week_no('d')} AS wk, {S.week_ending('d')} AS we
  FROM (SELECT CAST(gs AS DATE) AS d FROM generate_series(DATE '{year - 1}-01-01', DATE '{year}-12-31', INTERVAL 1 DAY) g(gs)))""",
                 f"""w AS (SELECT wk, max(we) AS e, max(d) AS l FROM days WHERE y = {year} GROUP BY wk)""",
                 f"""p AS (SELECT wk, max(we) AS e FROM days WHERE y = {year - 1} GROUP BY wk)""",
                 f"""n(n) AS (VALUES {ns})""",
                 f"""axis AS (
  SELECT wk, 'weeks_ty' AS family, n, e - (7 * n - 1) AS a, e AS z FROM w, n
  UNION ALL SELECT w.wk, 'weeks_ly', n, p.e - (7 * n - 1), p.e FROM w JOIN p ON p.wk = w.wk, n
  UNION ALL SELECT wk, 'week_ending', n, e - (7 * n + 6), e FROM w, n
  UNION ALL SELECT wk, 'prior_weeks', n, l - 365 - 7 * (n - 1), l - 365 FROM w, n
  UNION ALL SELECT wk, 'last_days', n, l - 7 * n, l FROM w, n
  UNION ALL SELECT w.wk, 'ytd_ty', {M.YTD_CHOICE}, DATE '{year}-01-01', (SELECT max(d) FROM days WHERE y = {year} AND days.wk <= w.wk) FROM w
  UNION ALL SELECT w.wk, 'ytd_ly', {M.YTD_CHOICE}, DATE '{year - 1}-01-01', (SELECT max(d) FROM days WHERE y = {year - 1} AND days.wk <= w.wk) FROM w
  UNION ALL SELECT wk, 'months', {N_MONTHS}, CAST(date_trunc('month', l - INTERVAL {back} MONTH) AS DATE), l FROM w
  UNION ALL SELECT wk, 'prior_months', {N_MONTHS}, CAST(date_trunc('month', l - INTERVAL {12 + back} MONTH) AS DATE), CAST(l - INTERVAL 12 MONTH AS DATE) FROM w
  UNION ALL SELECT wk, 'rolling_7d', 1, l - 6, l FROM w)""",
                 f"""daily AS (SELECT {member}, sale_date, sum(value) AS v FROM pos GROUP BY ALL)""") + f"""
SELECT CAST(x.wk AS INTEGER) AS week, x.family, CAST(x.n AS INTEGER) AS n, {member}, CAST(sum(v) AS DOUBLE) AS sales
FROM axis x JOIN daily ON sale_date BETWEEN x.a AND x.z GROUP BY ALL"""


def _anchored(spark: SparkSession, sf_dir: str, member: str, year: int) -> DataFrame:
    t = Tables(spark, sf_dir)
    windows = anchored_windows(year)
    days = C.envelope([r for *_, r in windows])
    totals = CU.write_cumulative(t, [member], dates=days)
    sums = CU.sums_between(totals, {i: w[3] for i, w in enumerate(windows)}, [member])
    # A parameter table: one row a window of the report.
    names = spark.createDataFrame([(i, *w[:3]) for i, w in enumerate(windows)], "window_id int, week int, family string, n int")
    return sums.join(F.broadcast(names), "window_id").select("week", "family", "n", member, F.col("sales").cast("double").alias("sales"))


@query("every_anchor_by_retailer", _anchored_sql(SEL.year, "retailer"))
def every_anchor_by_retailer(spark: SparkSession, sf_dir: str, year: int = SEL.year) -> DataFrame:
    """Every window family (N weeks this and last year, year-to-week, week endings,
    prior weeks, last days, months, rolling days) of every N for every week
    of the year by retailer, from cumulative sums."""
    return _anchored(spark, sf_dir, "retailer", year)


@query("every_anchor_by_product", _anchored_sql(SEL.year, "product"))
def every_anchor_by_product(spark: SparkSession, sf_dir: str, year: int = SEL.year) -> DataFrame:
    """The same windows for every week of the year by product."""
    return _anchored(spark, sf_dir, "product", year)


# ------------------------------------------------ distinct stores by bitmaps

#: The levels of the store counts: grouping sets, the first being the total.
LEVELS = [[], ["retailer"], ["smm"], ["ssr"], ["product"], ["product", "retailer"]]
LEVEL_NAMES = ["total", "retailer", "smm", "ssr", "product", "product_retailer"]


def count_windows(sel: M.Selection) -> dict[str, DateRange]:
    wins = {f"w{n}": M.weekly_window(sel, n) for n in M.WEEK_CHOICES}
    return wins | {"ytd": M.ytd_window(sel), "w13_ly": M.weekly_window(sel, 13, last_year=True)}


def store_bitmaps(t: Tables, wins: dict[str, DateRange]) -> DataFrame:
    """Bitmaps of the stores with a line in each window, by SSR, SMM, retailer and product."""
    lines = R.attach_dims(R.sales_lines(t, C.envelope(wins.values())), t, ["product"])
    flags = [F.max(F.when(r.contains(F.col("sale_date")), True)).alias(n) for n, r in wins.items()]
    pairs = R.attach_dims(lines.groupBy("store", "product").agg(*flags), t, ["retailer", "smm", "ssr"])
    return BM.key_bitmaps(pairs, "store", ["retailer", "smm", "ssr", "product"], {n: F.col(n) for n in wins})


def _store_counts_sql(sel: M.Selection) -> str:
    wins = count_windows(sel)
    rows = " UNION ALL ".join(f"SELECT '{n}' AS win, DATE '{r.start}' AS a, DATE '{r.end}' AS z" for n, r in wins.items())
    sets = ", ".join("(" + ", ".join(["win", *s]) + ")" for s in LEVELS)
    level = " ".join(f"WHEN {sum(1 << (3 - i) for i, c in enumerate(('retailer', 'smm', 'ssr', 'product')) if c not in s)} THEN '{n}'"
                     for s, n in zip(LEVELS, LEVEL_NAMES))
    return _with(S.POS_FACT_CTE, f"wins AS ({rows})") + f"""
SELECT CASE GROUPING(retailer, smm, ssr, product) {level} END AS level, retailer, smm, ssr, product, win AS "window",
       CAST(count(DISTINCT store) + max(CASE WHEN store IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_stores
FROM pos JOIN wins ON sale_date BETWEEN a AND z GROUP BY GROUPING SETS ({sets})"""


@query("store_counts_every_level", _store_counts_sql(SEL))
def store_counts_every_level(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Distinct stores (BLANK counted once) with sales in every window, in total and by
    retailer, SMM, SSR, product, and product and retailer: one aggregate of
    bitmaps, OR-ed for each level."""
    wins = count_windows(sel)
    every = ["retailer", "smm", "ssr", "product"]
    levels = BM.merged(store_bitmaps(Tables(spark, sf_dir), wins), LEVELS, list(wins))
    found = BM.counts(levels, ["level", *every], list(wins))
    name = F.element_at(F.array(*[F.lit(n) for n in LEVEL_NAMES]), F.col("level") + 1)
    long = found.select(name.alias("level"), *every, F.explode(F.array(*[F.struct(F.lit(n).alias("window"), F.col(n).alias("n_stores")) for n in wins])).alias("x"))
    return long.select("level", *every, "x.*").where("n_stores > 0")


# ------------------------------------- filter removal at any axis, from a lattice

LATTICE_SETS = (("retailer", "ssr", "store"), ("retailer", "ssr", "product"), ("retailer", "ssr"), ("retailer", "product"), ("retailer",), ("product",), ())
#: Axis name: the columns of the report, and those whose filter is removed.
TOGGLES = {"store": (("retailer", "ssr", "store"), ("store",)), "ssr": (("retailer", "ssr"), ("ssr",)), "ssr_store": (("retailer", "store"), ("store",)),
           "product_in_ssr": (("retailer", "ssr", "product"), ("product",)), "product": (("product",), ("product",)),
           "retailer_of_product": (("retailer", "product"), ("retailer",)), "ssr_of_product": (("ssr", "product"), ("ssr",)),
           "everything": (("retailer", "ssr", "product"), ("retailer", "ssr", "product"))}
_AXES = ("retailer", "ssr", "product", "store")


def toggle_windows(sel: M.Selection) -> dict[str, DateRange]:
    return {"ty": M.weekly_window(sel, 4), "ly": M.weekly_window(sel, 4, last_year=True), "ytd": M.ytd_window(sel), "mtd": M.mtd_window(sel)}


def _toggles_sql(sel: M.Selection) -> str:
    wins = toggle_windows(sel)
    days = C.envelope(wins.values())
    sums = ", ".join(f"CAST(sum(value) FILTER (WHERE {r.sql('sale_date')}) AS DOUBLE) AS {n}" for n, r in wins.items())
    parts = []
    for axis, (by, removed) in TOGGLES.items():
        kept = [c for c in by if c not in removed]
        on = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in kept) or "TRUE"
        cols = ", ".join(f"a.{c}" if c in by else f"NULL AS {c}" for c in _AXES)
        parts.append(f"SELECT '{axis}' AS axis, {cols}, {', '.join(f'a.{n}' for n in wins)}, {', '.join(f'b.{n} AS {n}_all' for n in wins)} "
                     f"FROM (SELECT {', '.join(by)}, {sums} FROM pp GROUP BY ALL) a LEFT JOIN (SELECT {', '.join([*kept, sums])} FROM pp {'GROUP BY ALL' if kept else ''}) b ON {on}")
    return _with(S.POS_FACT_CTE, f"pp AS (SELECT * FROM pos WHERE {days.sql('sale_date')})") + " UNION ALL ".join(parts)


@query("toggles_every_axis", _toggles_sql(SEL))
def toggles_every_axis(spark: SparkSession, sf_dir: str, sel: M.Selection = SEL) -> DataFrame:
    """Weekly, year-to-week and month-to-date sales as filtered and with the filter on
    stores, SSRs, products, retailers or everything removed, for every axis of the report,
    all from one lattice of sums."""
    sums = LT.build(Tables(spark, sf_dir), toggle_windows(sel), LATTICE_SETS)
    kinds = {"retailer": "string", "ssr": "string", "product": "string", "store": "long"}
    out = None
    for axis, (by, removed) in TOGGLES.items():
        rows = sums.toggle(by, removed)
        measures = [c for c in rows.columns if c not in by]
        rows = rows.select(F.lit(axis).alias("axis"), *[F.col(c) if c in by else F.lit(None).cast(kinds[c]).alias(c) for c in _AXES],
                           *[F.col(m).cast("double").alias(m) for m in measures])
        out = rows if out is None else out.unionByName(rows)
    return out


# --------------------------------------------- a layout for filters on any column

LAYOUT_COLUMNS = ("sale_date", "store", "part_key")


def write_clustered_fact(t: Tables, path: str | None = None, files: int | None = None) -> str:
    """The POS lines clustered by date, store and product together."""
    path = path or scratch_path(t.spark, "clustered-fact")
    LY.write_clustered(R.sales_lines(t), LAYOUT_COLUMNS, path, files or int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    return path


_PICKED = """picked AS (SELECT (SELECT min(s_suppkey) FROM supplier) AS store, (SELECT min(p_partkey) FROM part) AS part, DATE '2000-06-01' AS a, DATE '2000-06-30' AS z)"""


@query("clustered_selections", f"""WITH pos AS (SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS d, CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem),
{_PICKED},
s AS (SELECT 'store' AS selection, v FROM pos, picked WHERE l_suppkey = store UNION ALL SELECT 'dates', v FROM pos, picked WHERE d BETWEEN a AND z
      UNION ALL SELECT 'product', v FROM pos, picked WHERE l_partkey = part UNION ALL SELECT 'store and dates', v FROM pos, picked WHERE l_suppkey = store AND d BETWEEN a AND z)
SELECT selection, count(*) AS n_lines, CAST(sum(v) AS DOUBLE) AS sales FROM s GROUP BY selection""")
def clustered_selections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and sales of one store, of one month, of one product, and of the store in the
    month, each from the clustered copy of the fact, whose files cut on every column."""
    t = Tables(spark, sf_dir)
    path = write_clustered_fact(t)
    lines = spark.read.schema(R.sales_lines(t).schema).parquet(path)
    store, part = t.supplier.agg(F.min("s_suppkey")).first()[0], t.part.agg(F.min("p_partkey")).first()[0]
    days = DateRange(_dt.date(2000, 6, 1), _dt.date(2000, 6, 30)).contains(F.col("sale_date"))
    out = None
    for name, cond in (("store", F.col("store") == store), ("dates", days), ("product", F.col("part_key") == part),
                       ("store and dates", (F.col("store") == store) & days)):
        rows = lines.where(cond).groupBy(F.lit(name).alias("selection")).agg(F.count(F.lit(1)).alias("n_lines"), F.sum("value").cast("double").alias("sales"))
        out = rows if out is None else out.unionByName(rows)
    return out
