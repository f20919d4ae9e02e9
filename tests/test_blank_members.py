"""Fact rows without a dimension row: the blank member must keep its sales in
every query that groups, ranks or compares by it."""

import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import measures as M
from ledgerlight.plans import registry
from ledgerlight.plans.retail import SEL
from ledgerlight.sources import retail as R
from ledgerlight.sources.tables import TABLES, Tables
from tools.check_oracle import check_one

SF = "/root/testdata/sf0.001"
registry.load_all()


@pytest.fixture(scope="module")
def holes(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("holes"))
    cut = {"supplier": "s_suppkey % 4 <> 0", "part": "p_partkey % 5 <> 0", "customer": "c_custkey % 6 <> 0"}
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        df = df.where(cut[t]) if t in cut else df
        df.coalesce(1).write.parquet(f"{root}/{t}.parquet")
    return root


def _connection(root):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        try:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet/*.parquet')")
        except duckdb.IOException:
            continue
    return con


@pytest.mark.parametrize("name", ["store_total_toggle", "store_total_toggle_all", "weekly_ty_ly_by_week", "retailer_at_rank_k", "retailer_rank_flags",
                                  "retailer_total_rank", "category_total_toggle", "category_fact_load", "metric_catalogue_report",
                                  "rank_dispatch_smm_territory", "last_n_months_sweep", "product_mtd_ly", "feed_union", "ytd_by_week",
                                  "store_stats_by_retailer"])
def test_blank_members_match_the_oracle(spark, holes, name):
    status, msg, _ = check_one(spark, _connection(holes), holes, name, registry.QUERIES[name], registry.ORACLE[name])
    assert status == "OK", msg


def test_totals_are_the_plain_sums(spark, holes):
    t = Tables(spark, holes)
    window = M.weekly_window(SEL, 4)
    plain = float(R.sales_lines(t, window).agg(F.sum("value")).first()[0])
    toggle = registry.QUERIES["store_total_toggle"](spark, holes)
    assert float(toggle.where("custom_total = 'Filtered Stores'").agg(F.sum("ty_sales")).first()[0]) == pytest.approx(plain)
    per = toggle.where("custom_total = 'All Stores'").select("retailer", "ty_sales").distinct().collect()
    assert None in {r.retailer for r in per} and sum(r.ty_sales or 0 for r in per) == pytest.approx(plain)
    week = registry.QUERIES["weekly_ty_ly_by_week"](spark, holes).where(F.col("week") == SEL.week).collect()
    assert sum(r.ty_sales or 0 for r in week) == pytest.approx(plain)
    lines = t.lineitem.where(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    assert registry.QUERIES["feed_union"](spark, holes).agg(F.sum("n_rows")).first()[0] == lines.count()
    held = registry.QUERIES["retailer_at_rank_k"](spark, holes).where("product is null and retailer_at_k is not null").count()
    assert held > 0


def test_a_retry_closes_all_methods_of_a_visit(spark):
    from ledgerlight.operators import state as ST
    from ledgerlight.plans import clinical as PC
    schema = "subjectKey string, study_key string, visit_instance_id string, method string, responsestatus string, error_message string, inserted_date int"
    log = spark.createDataFrame([("K", "S", "1", "insert", "FAILURE", "x", 1), ("K", "S", None, "insert", "FAILURE", "x", 1),
                                 ("K", "S", "2", "insert", "FAILURE", "x", 1), ("K", "S", "3", "insert", "SUCCESSFUL", None, 1)], schema)
    batch = spark.createDataFrame([("K", "S", "1", "update", "SUCCESSFUL", None, 2), ("K", "S", None, "update", "SUCCESSFUL", None, 2),
                                   ("K", "S", "2", "update", "FAILURE", "y", 2), ("K", "S", "3", "update", "SUCCESSFUL", None, 2)], schema)
    out = ST.merge_upsert(log, batch, PC.LOG_KEYS, PC.LOG_UPDATES, close_on=PC.VISIT_KEYS)
    got = {(r.visit_instance_id, r.method): (r.responsestatus, r.inserted_date) for r in out.collect()}
    assert got == {("1", "insert"): ("SUCCESSFUL", 2), ("1", "update"): ("SUCCESSFUL", 2), (None, "insert"): ("SUCCESSFUL", 2),
                   (None, "update"): ("SUCCESSFUL", 2), ("2", "insert"): ("FAILURE", 1), ("2", "update"): ("FAILURE", 2),
                   ("3", "insert"): ("SUCCESSFUL", 1), ("3", "update"): ("SUCCESSFUL", 2)}
