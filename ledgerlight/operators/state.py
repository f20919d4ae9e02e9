"""Incremental state without a transactional table format: watermarks,
change windows, outcome-log MERGE, predicate delete, truncate, run log.

Every 'update' is a rewrite: the new version of a table is computed as a
DataFrame and written to a NEW folder (``sinks.write_version``); a path is
never overwritten while it is being read.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_z
from .joins import first_per_key


# ------------------------------------------------------------ watermarks

def extraction_windows(config: DataFrame, max_ts: Column, table_col: str = "Table",
                       date_col: str = "Latest_Date") -> DataFrame:
    """One row per configured table with a parsable watermark:
    (table_name, min_ts, max_ts, min_date, max_date, filter).  Rows whose
    date is missing or unparsable are skipped."""
    lo = F.try_to_timestamp(F.col(date_col)).cast("timestamp_ntz")
    c = config.select(F.col(table_col).alias("table_name"), lo.alias("min_ts")).where(F.col("min_ts").isNotNull())
    c = c.withColumn("max_ts", max_ts.cast("timestamp_ntz"))
    c = c.withColumn("min_date", iso_z(F.col("min_ts"))).withColumn("max_date", iso_z(F.col("max_ts")))
    # Fixed value: the filter syntax of the source's API.
    return c.withColumn("filter", F.concat(
        F.lit("dateCreated>"), F.col("min_date"), F.lit(" and dateCreated<"), F.col("max_date"),
        F.lit(" or dateModified>"), F.col("min_date"), F.lit(" and dateModified<"), F.col("max_date")))


def in_change_window(created: Column, modified: Column, lo: Column, hi: Column, strict: bool = False) -> Column:
    """(created in window) or (modified in window), half-open (lo, hi]: a
    row stamped exactly on a bound is in one of two consecutive windows.
    ``strict`` is the source job's open interval (lo, hi), which loses it."""
    if strict:
        inside = lambda c: (c > lo) & (c < hi)
    else:
        inside = lambda c: (c > lo) & (c <= hi)
    return inside(created) | inside(modified)


def changed_since(created: Column, modified: Column, since: Column) -> Column:
    """Inclusive since-watermark test."""
    return (created >= since) | (modified >= since)


def read_watermark(config: DataFrame, name: str, default: _dt.datetime, name_col: str = "table_name",
                   value_col: str = "last_sync") -> DataFrame:
    """One-row frame holding the stored watermark, or the default."""
    from ..sources.clinical import ntz_literal
    return (config.where(F.col(name_col) == name)
                  .agg(F.max(value_col).alias("w"))
                  .select(F.coalesce(F.col("w").cast("timestamp_ntz"), ntz_literal(default)).alias("watermark")))


def advance_table_watermark(config: DataFrame, table: str, new_value: Column, success_count: Column | None = None,
                            table_col: str = "Table", date_col: str = "Latest_Date") -> DataFrame:
    """Set one table's watermark; with ``success_count`` only when it is
    at least one (a run without a success keeps the old value)."""
    cond = F.col(table_col) == table
    if success_count is not None:
        cond = cond & (success_count >= 1)
    return config.withColumn(date_col, F.when(cond, new_value).otherwise(F.col(date_col)))


def advance_sync_watermark(config: DataFrame, name: str, new_time: Column, success_count: Column,
                           name_col: str = "table_name", value_col: str = "last_sync") -> DataFrame:
    """The next version of the single-row last-sync table: the run's start
    time when it had at least one success, else the stored value.  (The
    caller writes it as a new version; the table is never edited in place.)"""
    old = config.where(F.col(name_col) == name).agg(F.max(value_col).alias("_old"))
    return old.select(F.lit(name).alias(name_col),
                      F.when(success_count >= 1, new_time.cast("timestamp_ntz"))
                       .otherwise(F.col("_old").cast("timestamp_ntz")).alias(value_col))


# ---------------------------------------------------------------- merge

def merge_upsert(target: DataFrame, source: DataFrame, keys, update_cols, null_safe: bool = True,
                 order_col: str | None = None, close_on=None) -> DataFrame:
    """MERGE: matched target rows take ``update_cols`` from the source,
    unmatched source rows are inserted, other target rows stay.

    The source is first reduced to one row per key (the latest by
    ``order_col`` when given), so no target row is matched twice.  With
    ``null_safe`` NULL key parts match each other (``<=>``); without it a
    NULL key never matches and the source row is inserted again.

    Only target rows whose key occurs in the source can change: the target
    is split by a semi / anti join on the source keys (a broadcast when the
    batch is small, so the untouched history is only scanned, not
    shuffled), and the full outer join runs on the touched part alone.

    ``close_on``: keys of a visit.  A visit that succeeds in the source
    closes its failed target rows of every method (they take the update
    columns of the success), so no old failure is retried again.

    The source is used several times: pass a materialised one."""
    keys = list(keys)
    cols = target.columns
    if order_col is not None:
        source = first_per_key(source, keys, [order_col], latest=True)
    if close_on is not None:
        target = _closed(target, source, close_on, update_cols)
    src_keys = source.select(*[F.col(k).alias(f"k_{k}") for k in keys]).distinct()

    def on_keys(df):
        conds = [(df[k].eqNullSafe(src_keys[f"k_{k}"]) if null_safe else (df[k] == src_keys[f"k_{k}"])) for k in keys]
        return reduce(lambda a, b: a & b, conds)

    untouched = target.join(src_keys, on_keys(target), "left_anti")
    touched = target.join(src_keys, on_keys(target), "left_semi")
    t = touched.select(*[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_in_t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in cols], F.lit(True).alias("_in_s"))
    conds = [(t[f"t_{k}"].eqNullSafe(s[f"s_{k}"]) if null_safe else (t[f"t_{k}"] == s[f"s_{k}"])) for k in keys]
    j = t.join(s, reduce(lambda a, b: a & b, conds), "full_outer")
    out = []
    for c in cols:
        if c in update_cols:
            out.append(F.when(F.col("_in_s").isNotNull(), F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c))
        else:
            out.append(F.when(F.col("_in_t").isNotNull(), F.col(f"t_{c}")).otherwise(F.col(f"s_{c}")).alias(c))
    return untouched.select(*cols).unionByName(j.select(*out))


def _closed(target: DataFrame, source: DataFrame, visit_keys, update_cols, status: str = "responsestatus",
            done: str = "SUCCESSFUL", failed: str = "FAILURE") -> DataFrame:
    """``target`` with the failed rows of visits that ``source`` completed
    brought up to date."""
    visit_keys, update_cols = list(visit_keys), list(update_cols)
    won = first_per_key(source.where(F.col(status) == done).select(*visit_keys, *update_cols), visit_keys, update_cols, latest=True)
    won = won.select(*[F.col(k).alias(f"v_{k}") for k in visit_keys], *[F.col(c).alias(f"v_{c}") for c in update_cols], F.lit(True).alias("_won"))
    on = reduce(lambda a, b: a & b, [target[k].eqNullSafe(won[f"v_{k}"]) for k in visit_keys])
    close = F.col("_won") & (F.col(status) == failed)
    j = target.join(won, on, "left").withColumn("_close", F.coalesce(close, F.lit(False)))
    return j.select(*[(F.when(F.col("_close"), F.col(f"v_{c}")).otherwise(F.col(c)).alias(c) if c in update_cols else F.col(c))
                      for c in target.columns])


def merge_to_next_version(current: DataFrame, source: DataFrame, next_path: str, keys, update_cols, partition_col: str,
                          null_safe: bool = True, close_on=None) -> DataFrame:
    """MERGE ``source`` into the table version ``current`` and write the
    result as a new version to ``next_path``, partitioned by
    ``partition_col``; readers of ``current`` keep their files.

    The source is reduced to one row per key (the greatest of the other
    columns), so a key repeated in the batch is not inserted twice.
    Writing the same version again (a replayed batch) replaces it."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(current.sparkSession)
    keys = list(keys)
    one = first_per_key(source.select(*current.columns), keys, [c for c in current.columns if c not in keys], latest=True)
    one = one.select(*current.columns).checkpoint(eager=True)      # used several times
    merged = merge_upsert(current, one, keys, update_cols, null_safe=null_safe, close_on=close_on)
    merged.write.mode("overwrite").partitionBy(partition_col).parquet(next_path)
    return current.sparkSession.read.schema(current.schema).parquet(next_path)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows that survive a DELETE ... WHERE predicate (NULL predicate keeps
    the row)."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def truncate(df: DataFrame) -> DataFrame:
    """Empty frame with the same schema."""
    return df.limit(0)


# -------------------------------------------------------------- run log

def run_log(per_table: DataFrame, layer: str, data_source: str, table_col: str = "table",
            rows_col: str = "row_count", start_col: str = "start_time", end_col: str = "end_time",
            error_col: str | None = None) -> DataFrame:
    """Execution-log rows from per-table run facts.  A table whose
    ``error_col`` is set failed; every other table succeeded, with or without
    rows (fixed values below are the log's status vocabulary)."""
    failed = F.col(error_col).isNotNull() if error_col is not None else F.lit(False)
    rows = F.coalesce(F.col(rows_col), F.lit(0))
    err = F.col(error_col) if error_col is not None else F.lit(None).cast("string")
    return per_table.select(
        F.col(table_col).alias("table"),
        F.when(failed, F.lit("Error")).otherwise(F.lit("ETL")).alias("log_type"),
        F.when(failed, F.lit("Fail")).otherwise(F.lit("Success")).alias("etl_status"),
        F.lit(layer).alias("layer"), F.lit(data_source).alias("data_source"),
        F.when(failed, err).alias("error"),
        F.when(failed, F.lit(500)).otherwise(F.lit(200)).cast("int").alias("status_code"),
        rows.cast("long").alias("row_count"),
        F.col(start_col).alias("start_time"), F.col(end_col).alias("end_time"),
        F.when(failed, F.concat(F.lit("Exception occurred: "), err))
         .when(rows > 0, F.lit("API Execution")).otherwise(F.lit("No data available")).alias("custom_description"))
