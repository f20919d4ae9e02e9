"""The choice and the sums of the lattice; pages found by seek."""

import random

import pytest

from ledgerlight.operators import lattice as LT
from ledgerlight.operators import measures as M
from ledgerlight.operators.paging import write_paged
from ledgerlight.plans.retail import SEL
from ledgerlight.plans.retail_windows import LATTICE_SETS, TOGGLES, toggle_windows
from ledgerlight.sources.tables import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark):
    t = Tables(spark, SF)
    return t, toggle_windows(SEL), LT.build(t, toggle_windows(SEL), LATTICE_SETS)


def rows_of(df, cols):
    return sorted((tuple(None if r[c] is None else float(r[c]) if c in ("ty", "ly", "ytd", "mtd") else r[c] for c in cols) for r in df.collect()), key=str)


@pytest.mark.parametrize("by", [(), ("retailer",), ("product",), ("ssr",), ("store",), ("product", "ssr"), ("retailer", "store")])
def test_answers_equal_direct_sums(built, by):
    t, wins, sums = built
    cols = [*by, *wins]
    direct = M.window_sums(t, wins, list(by))
    assert rows_of(sums.answer(by), cols) == rows_of(direct, cols)


def test_the_smallest_covering_set_answers(built, spark):
    sums = built[2]
    name = lambda by: sums.sets[sums.covering(by)]
    assert name(("product",)) == ("product",) and name(()) == () and name(("ssr",)) == ("retailer", "ssr")
    assert name(("store",)) == ("retailer", "ssr", "store") and name(("ssr", "product")) == ("retailer", "ssr", "product")
    with pytest.raises(LookupError):
        sums.covering(("store", "product"))
    by_size = LT.Lattice(spark, "x", "", (("a", "b"), ("a", "c"), ("a", "b", "c")), (50, 20, 90), ("n",))
    assert by_size.covering(("a",)) == 1 and by_size.covering(("b",)) == 0 and by_size.covering(("b", "c")) == 2


def test_an_answer_reads_one_set(built):
    sums = built[2]
    for by, number in ((("product",), 5), (("ssr",), 2)):
        assert all(f"_set={number}/" in f for f in sums.answer(by).inputFiles())


def test_toggles_keep_blank_members(built):
    _, wins, sums = built
    for by, removed in TOGGLES.values():
        own, out = sums.answer(by), sums.toggle(by, removed)
        assert rows_of(out, [*by, *wins]) == rows_of(own, [*by, *wins])
        kept = [c for c in by if c not in removed]
        total = {tuple(r[c] for c in kept): r for r in sums.answer(kept).collect()}
        for r in out.collect():
            assert all(r[f"{w}_all"] == total[tuple(r[c] for c in kept)][w] for w in wins)


def test_lattice_of_no_lines(spark, tmp_path):
    for name in ("lineitem", "part", "supplier", "nation", "region"):
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        (df.limit(0) if name == "lineitem" else df).write.parquet(f"{tmp_path}/{name}.parquet")
    sums = LT.build(Tables(spark, str(tmp_path)), toggle_windows(SEL), LATTICE_SETS)
    assert sums.answer(("product",)).count() == 0 and sums.toggle(("retailer", "ssr"), ("ssr",)).count() == 0


def test_pages_by_seek(spark):
    rng = random.Random(2)
    rows = sorted({(rng.choice([None, "a", "b", "c"]), rng.randrange(10 ** 6)) for _ in range(1000)}, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    df = spark.createDataFrame(rows, "s string, n long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paged = write_paged(df, ["s", "n"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert paged.total == len(rows) and len(paged.ranges) > 2
    for limit, offset in ((10, 0), (100, 0), (7, 499), (300, 350), (50, len(rows) - 20), (5, len(rows)), (0, 3), (len(rows) + 9, 0)):
        got = paged.page(limit, offset, at="place").collect()
        assert [(r.s, r.n) for r in got] == rows[offset:offset + limit]
        assert [r.place for r in got] == list(range(offset, min(offset + limit, len(rows)))) if limit else not got
    # A short page reads one range or two, wherever it lies.
    for offset in range(0, len(rows) - 5, 97):
        files = paged.page(5, offset).inputFiles()
        assert 1 <= len({f.split("_range=")[1].split("/")[0] for f in files}) <= 2
    assert write_paged(df.limit(0), ["s", "n"]).page(5).count() == 0
    assert paged.page(5, 0).columns == ["s", "n"]
