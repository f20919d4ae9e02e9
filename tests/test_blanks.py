from pyspark.sql import functions as F

from ledgerlight.functions import blanks as B

GRID = [(None, None), (None, 5.0), (5.0, None), (0.0, 5.0), (5.0, 0.0), (6.0, 3.0), (-3.0, 3.0), (3.0, -6.0)]


def _run(spark, expr):
    df = spark.createDataFrame(GRID, "ty double, ly double")
    return [r[0] for r in df.select(expr).collect()]


def test_blank_sub(spark):
    assert _run(spark, B.blank_sub(F.col("ty"), F.col("ly"))) == [None, -5.0, 5.0, -5.0, 5.0, 3.0, -6.0, 9.0]


def test_weekly_pct(spark):
    got = _run(spark, B.weekly_pct_change(F.col("ty"), F.col("ly")))
    # BLANK when LY is blank/0, when TY is blank or 0 (change of -100%).
    assert got[:5] == [None, None, None, None, None]
    assert got[5] == 1.0 and got[6] == 0.0 and got[7] == -0.5


def test_ytd_pct_alternate_zero(spark):
    got = _run(spark, B.ytd_pct_change(F.col("ty"), F.col("ly")))
    assert got[0] == 0.0 and got[2] == 0.0 and got[4] == 0.0
    assert got[1] == -1.0 and got[5] == 1.0 and got[7] == 1.5


def test_sign_and_flat(spark):
    assert _run(spark, B.sign_class(F.col("ty"))) == [0, 0, 1, 0, 1, 1, -1, 1]


def test_distinct_with_blank_and_selected_value(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), ("b",)], "k string")
    assert df.agg(B.distinct_with_blank(F.col("k"))).first()[0] == 3
    assert df.where("k = 'a'").agg(B.selected_value(F.col("k"))).first()[0] == "a"
    assert df.agg(B.selected_value(F.col("k"))).first()[0] is None


def test_mtd_pct_divides_by_abs_ly(spark):
    got = _run(spark, B.abs_ratio_change(F.col("ty"), F.col("ly")))
    assert got[:2] == [None, -1.0] and got[2] is None and got[4] is None
    assert got[5] == 1.0 and got[7] == 1.5  # (3 - -6) / |-6|


def test_trend_from_pct(spark):
    weekly = B.sign_class(B.weekly_pct_change(F.col("ty"), F.col("ly")))
    # blank pct (LY blank/0, TY blank/0) is flat; -3 vs 3 -> abs(-1) - 1 = 0 -> flat
    assert _run(spark, weekly) == [0, 0, 0, 0, 0, 1, 0, -1]
