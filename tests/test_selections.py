"""The flagship report against its SQL oracle over many selections: the
oracle derives the calendar and anchors in SQL, independently of the
driver-side window arithmetic."""

import pytest

from ledgerlight.operators import measures as M
from ledgerlight.plans import retail as PR
from tools.check_oracle import _rows, duck_connection

SF = "/root/testdata/sf0.001"
CASES = [(1996, 1, 4), (1996, 0, 1), (1997, 52, 13), (1998, 53, 4), (1999, 26, 52), (2000, 40, 9999),
         (2001, 10, 26), (2000, 1, 9999), (1996, 53, 1), (1999, 40, 5)]


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("y,w,n", CASES)
def test_nweek_report_matches_sql(spark, con, y, w, n):
    # Selections outside the fact's date span are not offered by a slicer;
    # the calendar spans 1995-01-02 .. 2001-11-04 here.
    df = PR.nweek_ty_ly_by_retailer(spark, SF, sel=M.Selection(y, w), n_weeks=n)
    got = _rows([r.asDict() for r in df.collect()], df.columns)
    cur = con.execute(PR.nweek_sql(y, w, n))
    cols = [d[0] for d in cur.description]
    exp = _rows([dict(zip(cols, r)) for r in cur.fetchall()], cols)
    assert got == exp


FAMILY_CASES = [(2000, 9), (2000, 1), (1996, 9), (2001, 44), (1997, 53), (1996, 0), (1999, 26), (1998, 1)]
FAMILIES = [("mtd_ytd_calendar_ly", "mtd_ytd_sql"), ("category_change", "category_change_sql"),
            ("last_prior_n_months", "last_prior_sql"), ("alt_week_windows", "alt_week_sql"),
            ("monday_week_windows", "_monday_sql")]


@pytest.mark.parametrize("query,sql_fn", FAMILIES)
def test_window_families_match_sql(spark, con, query, sql_fn):
    fn = getattr(PR, query)
    for y, w in FAMILY_CASES:
        df = fn(spark, SF, sel=M.Selection(y, w))
        got = _rows([r.asDict() for r in df.collect()], df.columns)
        cur = con.execute(getattr(PR, sql_fn)(y, w))
        cols = [d[0] for d in cur.description]
        exp = _rows([dict(zip(cols, r)) for r in cur.fetchall()], cols)
        assert got == exp, (query, y, w)
