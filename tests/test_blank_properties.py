"""Property test: the BLANK helpers agree with a plain-Python model of the
rules on generated (TY, LY) pairs."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlight.functions import blanks as B

money = st.one_of(st.none(), st.just(0), st.integers(min_value=-10_000_00, max_value=10_000_00))


def m_sub(a, b):
    if a is None and b is None:
        return None
    return (a or 0) - (b or 0)


def m_div(a, b, alt=None):
    if b is None or b == 0:
        return alt
    return None if a is None else a / b


def m_weekly(ty, ly):
    r = m_div(ty, ly)
    if r is None:
        return None
    x = abs(r) - 1
    return None if x == -1 else x


def m_ytd(ty, ly):
    return m_div(m_sub(ty, ly), None if ly is None else abs(ly), 0.0)


def m_mtd(ty, ly):
    return m_div(m_sub(ty, ly), None if ly is None else abs(ly))


def m_sign(x):
    return 0 if x is None or x == 0 else (1 if x > 0 else -1)


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and abs(a - b) <= 1e-9 * max(1.0, abs(b)))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(money, money), min_size=1, max_size=40))
def test_blank_rules_match_model(spark, pairs):
    df = spark.createDataFrame([(i, None if a is None else a / 100, None if b is None else b / 100)
                                for i, (a, b) in enumerate(pairs)], "i int, ty double, ly double")
    ty, ly = F.col("ty"), F.col("ly")
    out = df.select("i", "ty", "ly", B.blank_sub(ty, ly).alias("sub"), B.weekly_pct_change(ty, ly).alias("wk"),
                    B.ytd_pct_change(ty, ly).alias("ytd"), B.abs_ratio_change(ty, ly).alias("mtd"),
                    B.sign_class(B.weekly_pct_change(ty, ly)).alias("trend")).orderBy("i").collect()
    for r in out:
        assert close(r.sub, m_sub(r.ty, r.ly)), r
        assert close(r.wk, m_weekly(r.ty, r.ly)), r
        assert close(r.ytd, m_ytd(r.ty, r.ly)), r
        assert close(r.mtd, m_mtd(r.ty, r.ly)), r
        assert r.trend == m_sign(m_weekly(r.ty, r.ly)), r
