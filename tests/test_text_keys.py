from pyspark.sql import functions as F

from ledgerlight.functions import text as X
from ledgerlight.operators import feeds_etl as FE


def test_number_text(spark):
    df = spark.createDataFrame([(123.0,), (123.5,), (12345678.0,), (100.0,), (None,)], "x double")
    got = [r[0] for r in df.select(X.number_text(F.col("x"))).collect()]
    assert got == ["123", "123.5", "12345678", "100", None]


def test_feed_store_number(spark):
    vals = ["011#00045", "12#34#56", "12", "12#x", "abc", None, "12#"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(X.feed_store_number(F.col("s"))).collect()]
    assert got == [1145.0, 1234.0, 12.0, 12.0, None, None, 12.0]


def test_fact_join_key(spark):
    df = spark.createDataFrame([("12",), ("12#5",), ("12345678",), (None,), ("abc",)], "store_text string")
    df = FE.with_fact_join_key(df.withColumn("retailer_order", F.lit(3)))
    assert [r.join_key for r in df.collect()] == [123, 1253, 123456783, None, None]
    num = spark.createDataFrame([(12.5,), (123.0,)], "x double")
    assert [r[0] for r in num.select(X.join_key(X.fact_store_part(F.col("x")), F.lit(3))).collect()] == [1253, 1233]


def test_coverage_join_key(spark):
    vals = ["12", "12#34", "011#00045", "12#", None, "abc", "123.5"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    part = X.coverage_store_part(F.col("s"))
    got = [r[0] for r in df.select(X.join_key(part, F.lit(3))).collect()]
    assert got == [123, 12343, 11000453, 123, None, None, None]


def test_chain_cleanup_and_nan(spark):
    df = spark.createDataFrame([("  Walgreen Co\x01 ",), ("CVS Corp",), ("Wal Mart",), ("Target",)], "c string")
    got = [r[0] for r in df.select(X.clean_text(X.replace_in_order(F.col("c"), X.CHAIN_REPLACEMENTS))).collect()]
    assert got == ["Walgreens", "CVS", "Walmart", "Target"]
    dm = spark.createDataFrame([("  ",), ("nan",), ("Ann",)], "d string")
    got = [r[0] for r in dm.select(X.replace_in_order(F.col("d"), X.DISTRICT_MANAGER_REPLACEMENTS)).collect()]
    assert got == ["", "", "Ann"]
    assert [r[0] for r in dm.select(X.nan_to_null(F.col("d"))).collect()] == ["  ", None, "Ann"]


def test_split_part_is_ansi_safe(spark):
    df = spark.createDataFrame([("a#b#c",), ("a",), (None,)], "s string")
    got = [(r[0], r[1]) for r in df.select(X.split_part(F.col("s"), "#", 1), X.split_part(F.col("s"), "#", 2)).collect()]
    assert got == [("a", "b#c"), ("a", None), (None, None)]


def test_coverage_pipeline_right_join(spark):
    cov = spark.createDataFrame([
        ("CVS Corp", "12#34", "West"), ("Unknown Chain", "7", "Z No Cov"), ("Walgreen Co", "5", "Northeast"),
        ("Walgreen Co", "5", "Northeast")], "master_chain string, store_num_text string, smm string")
    ro = spark.createDataFrame([("CVS", 1), ("Walgreens", 5), ("Target", 4)], "retailer string, retailer_order long")
    out = FE.coverage_pipeline(cov, ro, first_smm=("West", "Northeast"), second_smm=("Z No Cov",))
    rows = sorted(out.collect(), key=lambda r: (r.chain, str(r.join_key)))
    assert [(r.chain, r.join_key, r.occurrence) for r in rows] == [
        ("CVS", 12341, 1), ("Target", None, None), ("Walgreens", 55, 2), ("Walgreens", 55, 2)]
    assert {r.smm_sort for r in rows if r.chain != "Target"} == {1}
    assert rows[0].smm_territory == "Covered"


def test_coverage_pipeline_cleanups_and_key_checks(spark):
    from ledgerlight.operators import quality as Q
    cov = spark.createDataFrame([
        ("CVS Corp", "12", "West", "  ", "nan"), ("CVS Corp", "12", "West", "Ann nan", "North"),
        ("CVS Corp", None, "West", None, None)],
        "master_chain string, store_num_text string, smm string, district_manager string, region string")
    ro = spark.createDataFrame([("CVS", 1)], "retailer string, retailer_order long")
    wide = cov.selectExpr("*", "region AS district", "concat('x', region) AS division_group", "region AS javelin_territory_id")
    clean = FE.coverage_pipeline(wide, ro).select("region", "district", "division_group", "javelin_territory_id").collect()
    assert sorted(map(str, map(tuple, clean))) == sorted(map(str, [
        ("", "", "x", ""), ("North", "North", "xNorth", "North"), (None, None, None, None)]))
    out = FE.coverage_pipeline(cov, ro).orderBy("district_manager").collect()
    assert sorted(str(r.district_manager) for r in out) == ["", "Ann ", "None"]
    assert sorted(str(r.region_new) for r in out) == ["None", "None", "North"]
    checks = Q.key_checks(FE.coverage_pipeline(cov, ro), "join_key").first()
    assert (checks.n_rows, checks.null_keys, checks.dup_keys, checks.max_occurrence) == (3, 1, 1, 2)
