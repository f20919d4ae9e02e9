"""Sums of any window from cumulative sums, and distinct counts from bitmaps,
against plain Python over hand-made rows."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlight.functions.calendar import EMPTY, DateRange
from ledgerlight.operators import bitmaps as BM
from ledgerlight.operators import cumulative as CU
from ledgerlight.operators import measures as M
from ledgerlight.plans.retail_windows import anchored_windows
from ledgerlight.sources.tables import Tables

SF = "/root/testdata/sf0.001"
DAY = dt.date(2000, 1, 1)


def daily_rows(seed, first=0, days=60):
    rng = random.Random(seed)
    rows = {}
    for member in ("a", "b", None):
        for i in range(first, first + days):
            if rng.random() < 0.4:
                rows[(member, DAY + dt.timedelta(days=i))] = (Decimal(rng.randrange(-500, 500)) / 100, rng.randrange(1, 4))
    rows[("zero", DAY + dt.timedelta(days=first + 3))] = (Decimal("0.00"), 2)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*k, *v) for k, v in rows.items()], "m string, sale_date date, value decimal(18,2), lines long")


def direct(rows, windows):
    out = {}
    for i, r in windows.items():
        for (m, d), (v, n) in rows.items():
            if not r.empty and r.start <= d <= r.end:
                out[(m, i)] = out.get((m, i), 0) + v
    return out


WINDOWS = {i: DateRange(DAY + dt.timedelta(days=a), DAY + dt.timedelta(days=z))
           for i, (a, z) in enumerate([(0, 0), (-30, -1), (-5, 200), (3, 3), (10, 40), (59, 90), (61, 99), (40, 10)])} | {50: EMPTY}


def test_any_window_from_cumulative_sums(spark):
    rows = daily_rows(1)
    totals = CU.cumulative(frame(spark, rows), ["m"])
    got = {(r.m, r.window_id): r.sales for r in CU.sums_between(totals, WINDOWS, ["m"]).collect()}
    assert got == direct(rows, WINDOWS)
    assert got[("zero", 3)] == 0                      # lines that add up to 0 are no blank
    assert CU.sums_between(totals, {1: EMPTY}, ["m"]).count() == 0
    assert CU.sums_between(totals.limit(0), WINDOWS, ["m"]).count() == 0


def test_later_days_go_on_from_the_last_totals(spark):
    old, new = daily_rows(1), daily_rows(2, first=60, days=40) | {("new", DAY + dt.timedelta(days=70)): (Decimal("7.50"), 1)}
    totals = CU.extend_cumulative(CU.cumulative(frame(spark, old), ["m"]), frame(spark, new), ["m"])
    got = {(r.m, r.window_id): r.sales for r in CU.sums_between(totals, WINDOWS, ["m"]).collect()}
    assert got == direct(old | new, WINDOWS)


def test_every_anchor_equals_the_one_scan_report(spark):
    t = Tables(spark, SF)
    windows = anchored_windows(2000)
    totals = CU.write_cumulative(t, ["ssr"])
    sums = {(r.ssr, r.window_id): float(r.sales) for r in CU.sums_between(totals, {i: w[3] for i, w in enumerate(windows)}, ["ssr"]).collect()}
    for week in (0, 9, 40, 53):
        some = {f"w{i}": w[3] for i, w in enumerate(windows) if w[0] == week}
        for r in M.window_sums(t, some, ["ssr"]).collect():
            for name in some:
                want = r[name]
                assert sums.get((r.ssr, int(name[1:]))) == (None if want is None else float(want)), (week, name)


def test_bitmap_counts_of_overlapping_groups(spark):
    rng = random.Random(3)
    keys = [None, 0, 1, 32767, 32768, 32769, 10 ** 9, -1, -40000] + [rng.randrange(10 ** 6) for _ in range(60)]
    rows = [(rng.choice(keys), rng.choice(["x", "y", None]), rng.choice(["p", "q"]), rng.random() < 0.5) for _ in range(600)]
    df = spark.createDataFrame(rows, "k long, g string, h string, ok boolean")
    bitmaps = BM.key_bitmaps(df, "k", ["g", "h"], {"every": F.lit(True), "some": F.col("ok")})
    sets = [[], ["g"], ["h"], ["h", "g"]]
    got = {(r.level, r.g, r.h): (r.every, r.some) for r in BM.counts(BM.merged(bitmaps, sets, ["every", "some"]), ["level", "g", "h"], ["every", "some"]).collect()}
    want = {}
    for level, cols in enumerate(sets):
        for k, g, h, ok in rows:
            at = want.setdefault((level, g if "g" in cols else None, h if "h" in cols else None), (set(), set()))
            at[0].add(k)
            if ok:
                at[1].add(k)
    assert got == {k: (len(a), len(b)) for k, (a, b) in want.items()}
    none = BM.merged(BM.key_bitmaps(df.limit(0), "k", ["g"], {"every": F.lit(True)}), [["g"]], ["every"])
    assert BM.counts(none, ["level", "g"], ["every"]).count() == 0


def test_bitmaps_merge_like_one(spark):
    df = spark.range(0, 100000).select("id", (F.col("id") * 7 % 50000).alias("k"), (F.col("id") % 3).alias("g"))
    parts = [BM.key_bitmaps(df.where(c), "k", ["g"], {"n": F.lit(True)}) for c in ("id < 60000", "id >= 30000")]
    both = BM.counts(BM.merged(parts[0].unionByName(parts[1]), [["g"]], ["n"]), ["g"], ["n"])
    want = {r.g: r.n for r in df.groupBy("g").agg(F.count_distinct("k").alias("n")).collect()}
    assert {r.g: r.n for r in both.collect()} == want
