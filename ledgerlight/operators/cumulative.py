"""Window sums for any anchor from cumulative sums.

The fact is reduced once to running totals by member and day and written
(``write_cumulative``).  The sum of any closed range of days is then the
running total as of its last day less that as of the day before its first, so
every window length and every anchor costs two look-ups, never a pass over
the days inside it:

* the days that any window of a report begins or ends on are few and shared
  (``bounds_of``): each member looks them up once, by merging them with its
  running totals in day order (last total at or before the day);
* a window takes its two look-ups with the signs + and -, so windows meet
  their totals in one join with the list of bounds and one sum.

A member's rows are its days with sales, so its group in the merge is bounded
by the calendar, not by its sales.  The list of bounds is a parameter table:
two rows a window, at most ``MAX_BOUNDS`` in all, which is checked.
Totals are exact decimals, and lines are counted along, so a window without a
line gives no row (BLANK) while one whose lines add up to 0 gives 0.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import DateRange
from ..session import scratch_path
from ..sources import retail as R
from ..sources.tables import Tables

MAX_BOUNDS = 1_000_000


def cumulative(daily: DataFrame, members) -> DataFrame:
    """``daily`` (members, sale_date, value, lines; one row a day) with
    ``running`` and ``running_lines``, both up to and with the day."""
    members = list(members)
    upto = Window.partitionBy(*members).orderBy("sale_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(*members, "sale_date", F.sum("value").over(upto).alias("running"),
                        F.sum("lines").over(upto).alias("running_lines"))


def daily_sales(t: Tables, members, dates: DateRange | None = None) -> DataFrame:
    """Sales and lines by member and day; lines without a date are in no window."""
    members = list(members)
    lines = R.sales_lines(t, dates).where(F.col("sale_date").isNotNull())
    products = sorted(set(members) & set(R.PRODUCT_ATTRS))
    if products:
        lines = R.attach_dims(lines, t, products)
    pre = lines.groupBy("store", *products, "sale_date").agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("lines"))
    fact = R.attach_dims(pre, t, set(members) & set(R.STORE_ATTRS))
    return fact.groupBy(*members, "sale_date").agg(F.sum("value").alias("value"), F.sum("lines").alias("lines"))


def write_cumulative(t: Tables, members, path: str | None = None, dates: DateRange | None = None) -> DataFrame:
    """The running totals by ``members`` and day, written once and read back."""
    path = path or scratch_path(t.spark, "cumulative")
    totals = cumulative(daily_sales(t, members, dates), members)
    totals.write.mode("error").parquet(path)
    return t.spark.read.schema(totals.schema).parquet(path)


def extend_cumulative(totals: DataFrame, later: DataFrame, members) -> DataFrame:
    """``totals`` with further days (as ``daily_sales`` gives them), all later than
    a member's last: the new days go on from its last total, older rows stay."""
    members = list(members)
    last = totals.groupBy(*members).agg(F.max(F.struct("sale_date", "running", "running_lines")).alias("l"))
    new = cumulative(later, members)
    on = [new[m].eqNullSafe(last[m]) for m in members]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    go_on = new.join(last, cond, "left").select(
        *[new[m] for m in members], new["sale_date"],
        (new["running"] + F.coalesce(F.col("l.running"), F.lit(0))).alias("running"),
        (new["running_lines"] + F.coalesce(F.col("l.running_lines"), F.lit(0))).alias("running_lines"))
    kinds = dict(totals.dtypes)
    return totals.unionByName(go_on.select(*[F.col(c).cast(kinds[c]).alias(c) for c in totals.columns]))


def bounds_of(spark: SparkSession, windows: dict[int, DateRange]) -> DataFrame:
    """(bound, window_id, sign): the days whose running totals make up each window."""
    live = {i: r for i, r in windows.items() if not r.empty}
    rows = [(r.end, i, 1) for i, r in live.items()] + [(r.start - _dt.timedelta(days=1), i, -1) for i, r in live.items()]
    if len(rows) > MAX_BOUNDS:
        raise ValueError(f"{len(rows)} bounds: split the windows into several reports")
    return spark.createDataFrame(rows, "bound date, window_id int, sign int")


def as_of(totals: DataFrame, days, members) -> DataFrame:
    """(members, bound, running, running_lines) for every member and day of
    ``days``: the totals of the member's last day at or before it, 0 before its first."""
    members = list(members)
    asked_days = F.split(F.lit(",".join(sorted(d.isoformat() for d in set(days)))), ",").cast("array<date>")
    asked = totals.select(*members).distinct().select(*members, F.explode(asked_days).alias("sale_date"))
    merged = (totals.select(*members, "sale_date", "running", "running_lines", F.lit(0).alias("asked"))
              .unionByName(asked.select(*members, "sale_date", F.lit(None).cast(totals.schema["running"].dataType).alias("running"),
                                        F.lit(None).cast("long").alias("running_lines"), F.lit(1).alias("asked"))))
    before = Window.partitionBy(*members).orderBy("sale_date", "asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.lit(0)).alias(c)
    found = merged.select(*members, F.col("sale_date").alias("bound"), last("running"), last("running_lines"), "asked")
    return found.where("asked = 1").drop("asked")


def sums_between(totals: DataFrame, windows: dict[int, DateRange], members) -> DataFrame:
    """(members, window_id, sales) for every member and window with at least one
    line.  ``windows``: by id, any closed ranges of days."""
    members = list(members)
    bounds = bounds_of(totals.sparkSession, windows)
    live = [r for r in windows.values() if not r.empty]
    if not live:
        return totals.select(*members, F.lit(0).alias("window_id"), F.col("running").cast("decimal(28,2)").alias("sales")).limit(0)
    days = [r.end for r in live] + [r.start - _dt.timedelta(days=1) for r in live]
    signed = as_of(totals, days, members).join(F.broadcast(bounds), "bound")
    sums = signed.groupBy(*members, "window_id").agg(
        F.sum(F.col("running") * F.col("sign")).cast("decimal(28,2)").alias("sales"),
        F.sum(F.col("running_lines") * F.col("sign")).alias("lines"))
    return sums.where("lines > 0").drop("lines")
