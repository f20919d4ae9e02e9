"""Long-format metric reports, metric catalogues and pooled comparisons.

The report model picks "a metric for a window" from parameter tables.  Here
all metrics of all windows are computed in one aggregation, then
``unpivot`` turns the metric columns into rows and the (fixed, tiny)
catalogue tables are joined on.  Catalogues are literal code tables, so
they are broadcast without a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def metric_catalogue(spark: SparkSession, metrics) -> DataFrame:
    """``metrics`` = [(label, column, order, category), ...]."""
    return spark.createDataFrame([(l, c, int(o), k) for l, c, o, k in metrics],
                                 "metric string, metric_col string, metric_ord int, category string")


def long_metric_report(spark: SparkSession, wide: DataFrame, id_cols, metrics, windows: DataFrame | None = None,
                       window_key: str | None = None) -> DataFrame:
    """Unpivot ``wide``'s metric columns to rows labelled from the catalogue;
    optionally label the window key from the week-window table."""
    id_cols = list(id_cols)
    value_cols = [m[1] for m in metrics]
    long = wide.unpivot(id_cols, value_cols, "metric_col", "value")
    # Catalogue and week table are literal code tables: bounded by construction.
    out = long.join(F.broadcast(metric_catalogue(spark, metrics)), "metric_col").drop("metric_col")
    if windows is not None:
        wt = windows.select(F.col("weeks").alias(window_key), F.col("label").alias("window_label"),
                            F.col("sort").alias("window_sort"))
        out = out.join(F.broadcast(wt), window_key, "left")
    lead = id_cols + (["window_label", "window_sort"] if windows is not None else [])
    order = (["window_sort"] if windows is not None else []) + ["metric_ord"] + id_cols
    return (out.select(*lead, "metric", "metric_ord", "category", F.col("value").cast("double").alias("value"))
               .orderBy(*order))


def pooled_member(col: str, selected) -> F.Column:
    """Selected members keep their own label, every other member pools into
    'Others' (the 'customer vs others' axis)."""
    return F.when(F.col(col).isin(list(selected)), F.col(col)).otherwise(F.lit("Others"))


def choose_metric(wide: DataFrame, choice_col: str, options: dict) -> F.Column:
    """Pick one of several metric columns per row from a selector value
    (field-parameter style); unknown selector values give BLANK."""
    expr = None
    for key, col in options.items():
        expr = (F.when(F.col(choice_col) == F.lit(key), F.col(col)) if expr is None
                else expr.when(F.col(choice_col) == F.lit(key), F.col(col)))
    return expr


def store_toggle_rows(per_store: DataFrame, total_by: str, store: str, measures) -> DataFrame:
    """Two rows per store: its measures ('Filtered Stores') and those of its
    whole ``total_by`` member, the store filter removed ('All Stores'). The
    blank member's stores get the blank member's total."""
    totals = per_store.groupBy(total_by).agg(*[F.sum(m).alias(f"_all_{m}") for m in measures]).withColumnRenamed(total_by, "_total_of")
    j = per_store.join(totals, F.col(total_by).eqNullSafe(F.col("_total_of")), "left")
    rows = F.array(F.struct(F.lit("All Stores").alias("custom_total"), *[F.col(f"_all_{m}").alias(m) for m in measures]),
                   F.struct(F.lit("Filtered Stores").alias("custom_total"), *[F.col(m).cast(totals.schema[f"_all_{m}"].dataType).alias(m) for m in measures]))
    return j.select(total_by, store, F.explode(rows).alias("x")).select(total_by, store, "x.*")


def metric_order(order: F.Column, per_window: int, keys) -> F.Column:
    """Window key of a metric's order: the first ``per_window`` orders
    belong to the first key, and so on; blank beyond."""
    return F.get(F.array(*[F.lit(int(k)).cast("long") for k in keys]), F.floor((order - 1) / per_window).cast("int"))
