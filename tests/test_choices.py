"""Parameter choices, axes with a pooled member, sets and single members at their edges."""

from pyspark.sql import functions as F

from ledgerlight.functions import blanks as B
from ledgerlight.operators import measures as M
from ledgerlight.sources import params as P


def test_parameter_choices():
    assert M.sole_choice((), 13) == 13 and M.sole_choice((4,), 13) == 4
    assert M.sole_choice((4, 13), 1) == 1 and M.sole_choice((4, 4), 1) == 4
    assert M.greatest_choice((), (1, 4, 9999)) == 9999 and M.greatest_choice((4, 1), (1, 4, 9999)) == 4


def test_selected_value_is_the_only_one(spark):
    rows = [("one", "a"), ("one", "a"), ("one", None), ("two", "a"), ("two", "b"), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v string").groupBy("k").agg(B.selected_value(F.col("v")).alias("v"))
    assert {r.k: r.v for r in df.collect()} == {"one": "a", "two": None, "none": None}
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()       # no distinct values shuffled


def test_in_set_with_nulls_and_an_empty_set(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "n")], "k int, v string")
    some = spark.createDataFrame([(2,), (2,), (None,), (7,)], "m int")
    got = lambda d: sorted(r.v for r in d.collect())
    assert got(P.in_set(df, "k", some, "m")) == ["y", "z"]               # a repeated member repeats no row
    assert got(P.in_set(df, "k", some, "m", negate=True)) == ["x"]
    assert got(P.in_set(df, "k", some.limit(0), "m")) == [] and got(P.in_set(df, "k", some.limit(0), "m", negate=True)) == ["x", "y", "z"]


def test_axis_holds_the_blank_member_and_others_once(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "r string")
    assert sorted((r.r or "") for r in P.axis_with_others(df, "r").collect()) == ["", "Others", "a", "b"]
    assert [r.r for r in P.axis_with_others(df.limit(0), "r").collect()] == ["Others"]
