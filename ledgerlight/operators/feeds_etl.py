"""Feed union, fact join key and the coverage-file pipeline."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .quality import rows_per_key


def union_feeds(feeds: list[DataFrame]) -> DataFrame:
    """Union by column name; a column missing from a feed is NULL there;
    duplicates are kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def keep_valid_sales(df: DataFrame, product_col: str = "product", date_col: str = "sale_date",
                     floor: _dt.date = _dt.date(2023, 1, 1)) -> DataFrame:
    """Rows with a product and a date on or after the floor."""
    return df.where(F.col(product_col).isNotNull() & (F.col(date_col) >= F.lit(floor)))


def with_fact_join_key(df: DataFrame, store_col: str = "store_text", order_col: str = "retailer_order",
                       out: str = "join_key") -> DataFrame:
    """Feed store text -> store number ('#' parts) -> digits (split on '.')
    ++ retailer order."""
    part = X.fact_store_part(X.feed_store_number(F.col(store_col)))
    return df.withColumn(out, X.join_key(part, F.col(order_col)))


def smm_sort(smm: F.Column, first=(), second=()) -> F.Column:
    """1 for the first territory group, 2 for the second, else NULL."""
    return (F.when(smm.isin(list(first)), F.lit(1)).when(smm.isin(list(second)), F.lit(2))
             .otherwise(F.lit(None)).cast("int"))


def smm_territory(smm: F.Column) -> F.Column:
    return F.when(F.instr(smm, "Cov") > 0, smm).otherwise(F.lit("Covered"))


# Coverage columns whose 'nan' text is blanked.
NAN_COLUMNS = ("javelin_territory_id", "region", "division_group", "district")


def coverage_pipeline(cov: DataFrame, retailer_order: DataFrame, first_smm=(), second_smm=()) -> DataFrame:
    """Coverage file -> cleaned store dimension keyed like the fact.

    cov needs: master_chain, store_num_text, smm and optional text columns
    district_manager, region.  Steps: chain fix-ups, trim/clean, territory
    sort and label, '#'-split store number, RIGHT join to the retailer
    order table (unknown chains drop out, retailers without stores stay),
    join key, rows per key, 'nan' clean-ups."""
    chain = X.clean_text(X.replace_in_order(F.col("master_chain"), X.CHAIN_REPLACEMENTS))
    c = (cov.withColumn("chain", chain)
            .withColumn("smm_sort", smm_sort(F.col("smm"), first_smm, second_smm))
            .withColumn("smm_territory", smm_territory(F.col("smm")))
            .withColumn("store_num", X.coverage_store_part(F.col("store_num_text"))))
    # Right outer join: the preserved (right) side cannot be the broadcast
    # build side, so no hint; the planner broadcasts the coverage side when
    # it is small enough.
    ro = retailer_order.select(F.col("retailer").alias("chain_r"), "retailer_order")
    j = c.join(ro, c["chain"] == ro["chain_r"], "right")
    j = j.withColumn("join_key", X.join_key(F.col("store_num"), F.col("retailer_order")))
    j = j.withColumn("chain", F.coalesce(F.col("chain"), F.col("chain_r"))).drop("chain_r")
    if "district_manager" in cov.columns:
        j = j.withColumn("district_manager", X.replace_in_order(F.col("district_manager"),
                                                                X.DISTRICT_MANAGER_REPLACEMENTS))
    if "region" in cov.columns:
        j = j.withColumn("region_new", X.nan_to_null(F.col("region")))
    for c in NAN_COLUMNS:
        if c in cov.columns:
            j = j.withColumn(c, X.nan_to_empty(F.col(c)))
    return rows_per_key(j, "join_key")
