import datetime as dt

from pyspark.sql import functions as F

from ledgerlight.functions import calendar as C
from ledgerlight.operators import measures as M


def test_week_rule_spark_matches_driver_arithmetic(spark):
    start, end = dt.date(2016, 1, 1), dt.date(2030, 12, 31)
    days = spark.range((end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    rows = days.select("d", C.week_no(F.col("d")).alias("w"), C.week_ending(F.col("d")).alias("we"),
                       C.monday_week_start(F.year("d"), C.week_no(F.col("d"))).alias("ms")).collect()
    assert len(rows) == (end - start).days + 1
    for r in rows:
        assert r.w == C.py_week_no(r.d), r
        assert r.we == C.py_week_ending(r.d), r
        assert r.ms == C.monday_start_py(r.d.year, r.w), r


def test_week_edges():
    # Jan 1 2022 is a Saturday: that day is week 0.
    assert C.py_week_no(dt.date(2022, 1, 1)) == 0
    assert C.py_week_no(dt.date(2022, 1, 2)) == 1
    assert C.py_week_no(dt.date(2021, 12, 31)) == 53
    assert C.py_week_no(dt.date(2023, 12, 31)) == 53
    assert C.py_week_ending(dt.date(2023, 12, 31)) == dt.date(2024, 1, 6)
    # 2028 starts on a Saturday, so Dec 31 (raw week 54) is week 53.
    assert C.py_week_no(dt.date(2028, 12, 31)) == 53
    assert C.py_week_no(dt.date(2024, 2, 29)) == 9


def test_anchor_and_windows():
    sel = M.Selection(2000, 40)
    end = C.anchor_week_ending(2000, 40)
    assert end.weekday() == 5  # Saturday
    w = M.weekly_window(sel, 4)
    assert (w.end - w.start).days == 27 and w.end == end
    assert M.weekly_window(sel, 5).empty
    assert M.weekly_window(sel, 9999) == C.year_to_week(2000, 40)
    ytd = C.year_to_week(2022, 0)
    assert ytd.start == ytd.end == dt.date(2022, 1, 1)
    assert C.year_to_week(2023, 0).empty
    assert M.weekly_window(M.Selection(2000, 60), 4).empty


def test_month_arithmetic_clamps():
    assert C.add_months(dt.date(2024, 2, 29), -12) == dt.date(2023, 2, 28)
    assert C.add_months(dt.date(2024, 3, 31), -1) == dt.date(2024, 2, 29)
    sel = M.Selection(2024, 9)
    mtd_ly = M.mtd_window(sel, last_year=True)
    assert mtd_ly.start == dt.date(mtd_ly.end.year, mtd_ly.end.month, 1)


def test_monday_windows():
    sel = M.Selection(2001, 10)
    st = C.monday_start_py(2001, 10)
    assert st.weekday() == 0
    assert M.monday_forward_window(sel, 4).end == st + dt.timedelta(days=27)
    assert M.monday_forward_window(M.Selection(2001, 53), 4).empty
    assert M.monday_ly_window(M.Selection(2001, 53), 1).empty
    assert M.monday_prev13_window(sel).end == st - dt.timedelta(days=1)
    assert M.monday_dispatch_window(sel, 2) == M.monday_prev13_window(sel)
    assert M.monday_dispatch_window(sel, 7).empty


def test_week_ending_carry(spark):
    from ledgerlight.operators import calendar_dim as CD
    b = spark.createDataFrame([(dt.date(2021, 12, 1), dt.date(2023, 1, 10))], "lo date, hi date")
    cal = CD.week_ending_carry(CD.calendar_attributes(CD.calendar_from_bounds(b)))
    got = {r.date: r.week_ending_date for r in cal.collect()}
    # 2022-12-25 (Sunday, week 52 of 2022) carries the last week-52 day of 2021.
    last52_2021 = max(d for d in got if d.year == 2021 and C.py_week_no(d) == 52)
    assert got[dt.date(2022, 12, 25)] == last52_2021
    assert got[dt.date(2022, 12, 24)] == dt.date(2022, 12, 24)  # Saturday keeps its own date
    # Week 52 days of 2021 have no 2020 in the calendar: blank.
    assert got[dt.date(2021, 12, 20)] is None


def test_selected_week_window():
    w = M.selected_week_window(M.Selection(2000, 40))
    assert (w.end - w.start).days == 6 and C.py_week_no(w.start) == 40 and C.py_week_no(w.end) == 40
    jan1 = M.selected_week_window(M.Selection(2022, 0))
    assert jan1.start == jan1.end == dt.date(2022, 1, 1)
    first = M.selected_week_window(M.Selection(2023, 1))  # Jan 1 2023 is a Sunday: a full week
    assert first.start == dt.date(2023, 1, 1) and first.end == dt.date(2023, 1, 7)
    assert M.selected_week_window(M.Selection(2023, 60)).empty


def test_same_period_last_year_month_end_rule():
    assert C.same_period_last_year(dt.date(2001, 2, 28)) == dt.date(2000, 2, 29)
    assert C.same_period_last_year(dt.date(2000, 2, 29)) == dt.date(1999, 2, 28)
    assert C.same_period_last_year(dt.date(2000, 1, 15)) == dt.date(1999, 1, 15)
    sel = M.Selection(2009, 9)                 # the selected week ends Saturday, Feb 28 2009
    assert sel.last_date == dt.date(2009, 2, 28)
    ly = M.mtd_window(sel, last_year=True)
    assert (ly.start, ly.end) == (dt.date(2008, 2, 1), dt.date(2008, 2, 29))
    # EDATE-style month arithmetic (N-month windows) keeps clamping instead.
    assert M.prior_n_months_window(sel, 1).end == dt.date(2008, 2, 28)
