import datetime as dt

from pyspark.sql import functions as F

from ledgerlight.operators import measures as M
from ledgerlight.sources import params as P
from ledgerlight.sources import sinks as K


def test_series_rename_primitive_map(spark):
    assert [r.value for r in P.number_series(spark, 1, 7, 3).collect()] == [1, 4, 7]
    df = spark.createDataFrame([(1, "nan", [1], "x")], "a int, b string, c array<int>, d string")
    assert P.rename_columns(df, {"a": "A", "zz": "y"}).columns == ["A", "b", "c", "d"]
    assert P.primitive_columns(df).columns == ["a", "b", "d"]
    out = P.map_columns_except(df.drop("c"), lambda c: F.replace(c.cast("string"), F.lit("nan"), F.lit("")), ["d"])
    assert tuple(out.first()) == ("1", "", "x")


def test_page_of_and_in_set(spark):
    df = spark.createDataFrame([(i, f"r{i % 3}") for i in range(10)], "i int, r string")
    assert [r.i for r in P.page_of(df, ["i"], 3, offset=3).collect()] == [3, 4, 5]
    members = spark.createDataFrame([("r1",), (None,)], "m string")
    assert sorted(r.i for r in P.in_set(df, "r", members, "m").collect()) == [1, 4, 7]
    assert len(P.in_set(df, "r", members, "m", negate=True).collect()) == 7


def test_axis_remap_contains_groups(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,), ("A",)], "retailer string")
    assert sorted(str(r.retailer) for r in P.axis_with_others(df, "retailer").collect()) == ["A", "B", "None", "Others"]
    nums = spark.createDataFrame([(i,) for i in range(1, 13)], "n int")
    assert [r[0] for r in nums.select(P.cascade_remap(F.col("n"))).collect()] == [10, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12]
    t = spark.createDataFrame([("Yearly % Change",), ("Weekly",), ("x",)], "s string")
    got = [r[0] for r in t.select(P.contains_category(F.col("s"), [("Yearly", "Yearly"), ("Week", "Weekly")])).collect()]
    assert got == ["Yearly", "Weekly", None]
    try:
        P.check_group_cols(["retailer", "bogus"], M.GROUPABLE)
        raise AssertionError("expected a ValueError")
    except ValueError:
        pass


def test_week_end_date():
    assert M.week_end_date(M.Selection(2023, 53)) is None
    assert M.week_end_date(M.Selection(2023, 52)) == dt.date(2023, 12, 30)
    # 2022 starts on a Saturday: plain WEEKNUM 52 is retail week 51.
    assert M.week_end_date(M.Selection(2022, 52)) == dt.date(2022, 12, 24)


def test_versioned_write_and_schema_evolution(spark, tmp_out):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    p = K.write_version(df, spark, "t")
    assert spark.read.parquet(p).count() == 1
    assert K.write_version(df, spark, "t") != p  # a new folder every time
    path = tmp_out + "/evolving"
    K.append_evolving(df, path)
    K.append_evolving(df.withColumn("extra", F.lit(2.5)), path)
    back = K.read_evolving(spark, path)
    assert set(back.columns) == {"i", "s", "extra"} and back.count() == 2


def test_table_or_default_and_overwrite(spark):
    default = spark.createDataFrame([("subject_visits", dt.datetime(2023, 10, 2))], "table_name string, last_sync timestamp_ntz")
    name = "cfg_test_sync"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert K.table_or_default(spark, name, default).count() == 1
    K.overwrite_table(default.withColumn("last_sync", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")), name)
    assert spark.table(name).first().last_sync == dt.datetime(2024, 1, 1)


def test_refresh_time_and_metric_choice(spark):
    from ledgerlight.operators.report import choose_metric, long_metric_report
    df = spark.createDataFrame([("A", 1.0, 2.0, "MTD"), ("B", 3.0, 4.0, "YTD"), ("C", 5.0, 6.0, "bogus")],
                               "r string, mtd double, ytd double, pick string")
    assert P.with_refresh_time(df).where("refreshed_at IS NULL").count() == 0
    got = {r.r: r.v for r in df.select("r", choose_metric(df, "pick", {"MTD": "mtd", "YTD": "ytd"}).alias("v")).collect()}
    assert got == {"A": 1.0, "B": 4.0, "C": None}
    long = long_metric_report(spark, df.drop("pick"), ["r"], [("MTD sales", "mtd", 1, "Sales"), ("YTD sales", "ytd", 2, "Sales")])
    rows = [(r.r, r.metric, r.metric_ord, r.value) for r in long.collect()]
    assert rows[:3] == [("A", "MTD sales", 1, 1.0), ("B", "MTD sales", 1, 3.0), ("C", "MTD sales", 1, 5.0)]
    assert len(rows) == 6


def test_bucketed_tables_join_without_shuffle(spark):
    log = spark.createDataFrame([(f"S{i % 7}", str(i), "FAILURE") for i in range(200)],
                                "study_key string, visit_instance_id string, responsestatus string")
    hist = spark.createDataFrame([(f"S{i % 7}", str(i), f"VIS-{i}") for i in range(0, 200, 2)],
                                 "study_key string, visit_instance_id string, target_visit_id string")
    keys = ["study_key", "visit_instance_id"]
    K.write_bucketed(log, "bk_log", keys, 8)
    K.write_bucketed(hist, "bk_hist", keys, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("bk_log").join(spark.table("bk_hist"), keys, "left")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert j.where("target_visit_id IS NOT NULL").count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
