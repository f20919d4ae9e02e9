"""Missing and damaged pages, against plain Python."""

from pyspark.sql import functions as F

from ledgerlight.session import scratch_path
from ledgerlight.sources import landing as L

FIELDS = ["k", "v"]


def landed(spark, pages, tmp=None, **faults):
    rows = [(s, p, f"{s}{p}{i}", 'quo"te, }' if i else None) for s, p in pages for i in range(3)]
    df = spark.createDataFrame(rows, "study string, p long, k string, v string")
    out = scratch_path(spark, "pages")
    L.land_numbered_pages(df, "study", "p", FIELDS, out, **faults)
    return out


def found(pages):
    return sorted(((r.studyKey, r.kind, r.first_page, r.last_page, r.n_pages) for r in L.page_faults(pages).collect()), key=str)


def at(*pairs):
    cond = F.lit(False)
    for s, p in pairs:
        cond = cond | ((F.col("study") == s) & (F.col("p") == p))
    return cond


def test_runs_of_missing_and_damaged_pages(spark):
    pages = [("a", p) for p in range(12)] + [("b", 0), ("c", 0), ("c", 1), ("d", 0), ("e", 0), ("e", 5)]
    out = landed(spark, pages, absent=at(("a", 0), ("a", 1), ("a", 5), ("a", 11), ("d", 0)),
                 cut_short=at(("a", 3), ("a", 4), ("a", 7), ("c", 1)), garbled=at(("a", 9), ("c", 0)))
    read = L.read_checked(spark, out, FIELDS)
    assert found(read) == sorted([
        ("a", "missing", 0, 1, 2), ("a", "missing", 5, 5, 1), ("a", "missing", 9, 9, 1), ("a", "missing", 11, 11, 1),
        ("a", "damaged", 3, 4, 2), ("a", "damaged", 7, 7, 1), ("a", "damaged", None, None, 1),
        ("c", "missing", 0, 0, 1), ("c", "damaged", 1, 1, 1), ("c", "damaged", None, None, 1),
        ("e", "missing", 1, 4, 4)], key=str)                     # d landed nothing, so nothing is known of it
    whole = sorted((r.studyKey, r.page, r.k, r.v) for r in L.whole_rows(read).where("v IS NOT NULL").collect())
    good = [("a", p) for p in (2, 6, 8, 10)] + [("b", 0), ("e", 0), ("e", 5)]
    assert whole == sorted((s, p, f"{s}{p}{i}", 'quo"te, }') for s, p in good for i in (1, 2))


def test_pages_landed_twice_and_none(spark):
    one = landed(spark, [("a", 0), ("a", 1)], cut_short=at(("a", 0)))
    two = landed(spark, [("a", 0), ("a", 1)])
    both = L.read_checked(spark, one, FIELDS).unionByName(L.read_checked(spark, two, FIELDS))
    assert found(both) == []
    assert found(both.limit(0)) == []
    only_bad = L.read_checked(spark, landed(spark, [("z", 0), ("z", 1)], garbled=at(("z", 0), ("z", 1))), FIELDS)
    assert found(only_bad) == [("z", "damaged", None, None, 2)]
