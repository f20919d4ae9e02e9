"""Date/time text parsing and formatting helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted visit-date layouts, tried in this order.
VISIT_DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss")
ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
SQL_TS = "yyyy-MM-dd HH:mm:ss"


def parse_two_formats(text: Column, formats=VISIT_DATE_FORMATS) -> Column:
    """First format that parses wins; unparsable or empty text gives NULL."""
    t = F.when(F.coalesce(text, F.lit("")) != "", text)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats])


def iso_date_from_two_formats(text: Column) -> Column:
    """Visit-date text -> ISO date text (yyyy-MM-dd) or NULL."""
    return F.date_format(F.to_date(parse_two_formats(text)), "yyyy-MM-dd")


def iso_z(ts: Column) -> Column:
    return F.date_format(ts, ISO_Z)


def iso_z_to_sql(text: Column) -> Column:
    """'2024-01-02T03:04:05Z' -> '2024-01-02 03:04:05'."""
    return F.date_format(F.try_to_timestamp(text, F.lit(ISO_Z)), SQL_TS)


def to_ntz(text: Column) -> Column:
    return F.try_to_timestamp(text).cast("timestamp_ntz")
