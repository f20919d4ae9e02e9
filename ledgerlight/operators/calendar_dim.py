"""Calendar dimension (one row per day between the fact's first and last
date) with the report's year / quarter / month / week attributes, and the
week-52 carry variant of the week-ending date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as C


def calendar_from_bounds(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Explode a one-row (lo, hi) frame into one row per day.  The row
    count is bounded by the date span, not by the data volume."""
    return bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 1 DAY"))).alias("date"),
                         F.col(hi).alias("last_date"))


def calendar_attributes(days: DataFrame) -> DataFrame:
    d = F.col("date")
    out = days.select(
        *days.columns,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        C.week_no(d).alias("week"),
        C.plain_weeknum(d).alias("weeknum"),
        F.date_format(d, "EEEE").alias("weekday_name"),
        C.dow(d).alias("weekday_number"),
        C.week_ending(d).alias("week_ending"),
        F.concat(F.date_format(d, "MMM"), F.lit(" "), F.year(d).cast("string")).alias("month_year_label"),
        (F.year(d) * 10000 + F.month(d) * 100).alias("date_key"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_no"),
        C.quarter_label(F.month(d)).alias("quarter"),
        C.leap_year(F.year(d)).alias("is_leap_year"),
        F.last_day(d).alias("month_end"),
    )
    out = out.withColumn("week_label", F.concat(F.lit("WK "), F.col("week").cast("string"), F.lit(", "),
                                                F.date_format("week_ending", "MM-dd-yyyy")))
    out = out.withColumn("week_no_label", F.concat(F.col("week").cast("string"), F.lit(" Week")))
    return out


def padded_bounds(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Widen (lo, hi) to whole years: Jan 1 of lo's year to Dec 31 of hi's."""
    return bounds.select(F.make_date(F.year(lo), F.lit(1), F.lit(1)).alias(lo),
                         F.make_date(F.year(hi), F.lit(12), F.lit(31)).alias(hi))


def latest_month_label(cal: DataFrame, last_date_col: str = "last_date") -> DataFrame:
    """'Latest ' for the newest month, else 'Mon YYYY' (``last_date_col``
    holds the calendar's maximum date, attached by a one-row join)."""
    same = (F.year("date") == F.year(last_date_col)) & (F.month("date") == F.month(last_date_col))
    return cal.withColumn("month_year", F.when(same, F.lit("Latest ")).otherwise(F.col("month_year_label")))


def week_ending_carry(cal: DataFrame) -> DataFrame:
    """Week-ending with the week-52 carry: a non-Saturday day in week 52
    takes the last week-52 date of the previous year (present in the
    calendar); every other day takes its Saturday."""
    last52 = (cal.where(F.col("week") == 52).groupBy("year").agg(F.max("date").alias("prev_w52"))
                 .select((F.col("year") + 1).alias("year"), "prev_w52"))
    j = cal.join(F.broadcast(last52), "year", "left")      # one row per year
    return j.withColumn("week_ending_date",
                        F.when((F.col("week") == 52) & (F.col("weekday_number") != 7), F.col("prev_w52"))
                         .otherwise(F.col("week_ending"))).drop("prev_w52")
