"""Edge rows listed for the fixtures: feed union, change windows with NULL
dates, record exclusions, log merge with both methods, new-year weeks."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlight.functions import calendar as C
from ledgerlight.operators import feeds_etl as FE
from ledgerlight.operators import state as ST


def test_feed_union_edges(spark):
    a = spark.createDataFrame([("Sun Veil ", "12", dt.date(2023, 5, 1), 10.0, dt.date(2023, 5, 2))],
                              "product string, store_text string, sale_date date, value double, inserted_date date")
    b = spark.createDataFrame([("SUN VEIL", "13", dt.date(2023, 5, 1), 5.0), (None, "14", dt.date(2023, 5, 1), 1.0),
                               ("BEACH TONE", "15", dt.date(2022, 12, 31), 2.0)],
                              "product string, store_text string, sale_date date, value double")
    u = FE.union_feeds([a, b]).withColumn("product", F.upper(F.trim("product")))
    kept = FE.keep_valid_sales(u, floor=dt.date(2023, 1, 1)).collect()
    assert sorted((r.product, r.store_text, r.inserted_date is None) for r in kept) == [
        ("SUN VEIL", "12", False), ("SUN VEIL", "13", True)]
    assert u.count() == 4  # duplicates and all feeds kept by the union itself


def test_change_window_null_dates(spark):
    df = spark.createDataFrame([(None, 5), (5, None), (None, None), (0, 0)], "c int, m int")
    rows = df.where(ST.in_change_window(F.col("c"), F.col("m"), F.lit(1), F.lit(10))).collect()
    got = sorted(((r.c, r.m) for r in rows), key=str)
    assert got == [(5, None), (None, 5)]
    rows = df.where(ST.changed_since(F.col("c"), F.col("m"), F.lit(5))).collect()
    since = sorted(((r.c, r.m) for r in rows), key=str)
    assert since == [(5, None), (None, 5)]


def test_record_exclusions_keep_null_type(spark):
    df = spark.createDataFrame([("CATALOG", "Done"), (None, "Done"), ("FORM", "New Record"), ("FORM", None),
                                ("FORM", "Done")], "t string, s string")
    keep = ~F.col("t").eqNullSafe(F.lit("CATALOG")) & ~F.col("s").eqNullSafe(F.lit("New Record"))
    assert sorted(map(tuple, df.where(keep).collect()), key=str) == [("FORM", "Done"), ("FORM", None), (None, "Done")]


def test_log_merge_both_methods_and_null_visit(spark):
    schema = "subjectKey string, study_key string, visit_instance_id string, method string, responsestatus string"
    log = spark.createDataFrame([("K", "S", "1", "insert", "FAILURE"), ("K", "S", None, "insert", "FAILURE")], schema)
    batch = spark.createDataFrame([("K", "S", "1", "update", "SUCCESSFUL"), ("K", "S", None, "insert", "SUCCESSFUL")],
                                  schema)
    out = sorted(map(tuple, ST.merge_upsert(log, batch, ["subjectKey", "study_key", "visit_instance_id", "method"],
                                            ["responsestatus"]).collect()), key=str)
    # The update outcome is a new row (method is part of the key); the NULL-id row is matched null-safely.
    assert out == sorted([("K", "S", "1", "insert", "FAILURE"), ("K", "S", "1", "update", "SUCCESSFUL"),
                          ("K", "S", None, "insert", "SUCCESSFUL")], key=str)


def test_new_year_weeks():
    weeks = {d: C.py_week_no(d) for d in (dt.date(2021, 12, 31), dt.date(2022, 1, 1), dt.date(2022, 1, 2),
                                          dt.date(2023, 12, 30), dt.date(2023, 12, 31), dt.date(2024, 1, 1),
                                          dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2028, 12, 30),
                                          dt.date(2028, 12, 31), dt.date(2029, 1, 1), dt.date(2029, 1, 6))}
    assert weeks[dt.date(2021, 12, 31)] == 53 and weeks[dt.date(2022, 1, 1)] == 0 and weeks[dt.date(2022, 1, 2)] == 1
    assert weeks[dt.date(2023, 12, 30)] == 52 and weeks[dt.date(2023, 12, 31)] == 53
    assert weeks[dt.date(2024, 1, 1)] == 1 and weeks[dt.date(2024, 1, 6)] == 1 and weeks[dt.date(2024, 1, 7)] == 2
    assert weeks[dt.date(2028, 12, 30)] == 52 and weeks[dt.date(2028, 12, 31)] == 53
    assert weeks[dt.date(2029, 1, 1)] == 1
    # The same Saturday closes week 53 of one year and week 1 of the next.
    assert C.py_week_ending(dt.date(2023, 12, 31)) == C.py_week_ending(dt.date(2024, 1, 1)) == dt.date(2024, 1, 6)


def test_iso_text_conversions(spark):
    from ledgerlight.functions import dates as D
    df = spark.createDataFrame([("2024-01-02T03:04:05Z", "2024-01-05 10:00:00.123456"), ("garbage", "2024-01-05 10:00:00"),
                                (None, "")], "iso string, visit string")
    got = [tuple(r) for r in df.select(D.iso_z_to_sql(F.col("iso")), D.iso_date_from_two_formats(F.col("visit"))).collect()]
    assert got == [("2024-01-02 03:04:05", "2024-01-05"), (None, "2024-01-05"), (None, None)]
    ntz = df.select(D.to_ntz(F.lit("2024-01-02 03:04:05")).alias("t")).first().t
    assert ntz == dt.datetime(2024, 1, 2, 3, 4, 5)
