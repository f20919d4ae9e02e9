"""The SQL API over the registered views and the DataFrame plan give the
same flagship result (Catalyst plans both)."""

from ledgerlight.operators import measures as M
from ledgerlight.plans import retail as PR
from ledgerlight.sources.tables import register_views

SF = "/root/testdata/sf0.001"


def test_sql_api_matches_dataframe_plan(spark):
    register_views(spark, SF, ["lineitem", "supplier", "nation", "region"])
    sel = M.Selection(2000, 40)
    ty, ly = M.weekly_window(sel, 4), M.weekly_window(sel, 4, last_year=True)
    sql = f"""
      SELECT r.r_name AS retailer,
             CAST(sum(CASE WHEN {ty.sql('to_date(l.l_shipdate)')} THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS ty_sales,
             CAST(sum(CASE WHEN {ly.sql('to_date(l.l_shipdate)')} THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS ly_sales
      FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
      LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
      WHERE to_date(l.l_shipdate) BETWEEN DATE '{ly.start}' AND DATE '{ty.end}'
      GROUP BY r.r_name"""
    via_sql = sorted(tuple(r) for r in spark.sql(sql).collect())
    df = PR.nweek_ty_ly_by_retailer(spark, SF, sel=sel, n_weeks=4).select("retailer", "ty_sales", "ly_sales")
    assert via_sql == sorted(tuple(r) for r in df.collect())
