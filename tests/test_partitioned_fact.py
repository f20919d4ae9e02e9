"""The month-partitioned fact layout gives the same window sums, with the
window pruning month folders."""

from ledgerlight.operators import measures as M
from ledgerlight.sources import retail as R
from ledgerlight.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def test_partitioned_fact_same_results_and_prunes(spark, tmp_out):
    t = Tables(spark, SF)
    path = R.write_fact_by_month(t, tmp_out + "/pos_by_month", partitions=4)
    ft = R.FactTables(spark, SF, path)
    sel = M.Selection(2000, 40)
    wins = {"ty": M.weekly_window(sel, 13), "ly": M.weekly_window(sel, 13, last_year=True),
            "ytd": M.ytd_window(sel)}
    a = sorted(tuple(r) for r in M.window_sums(t, wins, ["retailer"]).collect())
    b_df = M.window_sums(ft, wins, ["retailer"])
    b = sorted(tuple(r) for r in b_df.collect())
    assert a == b and len(a) == 5
    plan = b_df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sale_month" in plan
