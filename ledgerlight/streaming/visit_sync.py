"""The visit sync as a Structured Streaming job.

New source files (events landed as parquet) are picked up incrementally
by the file source; the stream's checkpoint replaces the hand-kept
last-sync watermark.  Each micro-batch is derived into visits, resolved
against the reference tables with the same set-based joins as the batch
job, and its outcome rows and payloads are written under
``<out>/epoch=<id>/``.  Writing by epoch id with overwrite makes a
re-executed micro-batch (after a failure) replace its own output, so the
sink is idempotent.  ``trigger(availableNow=True)`` drains what has landed
and stops, which suits a scheduled run.

With ``lateness`` an event that is landed again is dropped by state: the stream keeps
the ids and times of the events of that span (event time, behind the latest one), so a
replay neither reaches the log nor the payloads; events later than the span are dropped by
the watermark and left to the batch sync.  State is bounded by the span, not by the history.

With ``retry`` each micro-batch also takes up the visits that failed so far: they are kept
as ``<out>/pending/epoch=<id>`` (the visits of the version before and of the batch that
failed now), a newer event of a visit replaces its pending one, and a visit leaves the table
when it goes through.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import resolve as RV
from ..operators import state as ST
from ..operators.joins import first_per_key
from ..sources import clinical as C
from ..sources.tables import Tables

EVENTS_SCHEMA = ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


LOG_KEYS = ["subjectKey", "study_key", "visit_instance_id", "method"]
LOG_UPDATES = ["responsestatus", "error_message", "inserted_date"]
VISIT_KEYS = LOG_KEYS[:3]


def start_visit_sync(spark: SparkSession, events_dir: str, ref_dir: str, out_dir: str, checkpoint: str,
                     run_time: _dt.datetime, pushed_before: _dt.datetime, file_glob: str = "events*.parquet",
                     max_files_per_trigger: int = 64, log_path: str | None = None, lateness: str | None = None, retry: bool = False):
    """Start the stream; returns the StreamingQuery (call
    ``awaitTermination()`` or ``processAllAvailable()``).  Subjects and
    visits created before ``pushed_before`` already exist in the target.

    With ``log_path`` every micro-batch's outcomes are also MERGEd into an
    outcome log: version ``epoch=<id>`` there is version ``epoch=<id - 1>``
    (``epoch=-1`` is the log before the stream) with the batch merged in, so a
    replayed micro-batch writes the same version again and a reader keeps
    the one it began with.

    The reference tables are built once, before the first micro-batch."""
    refs = Tables(spark, ref_dir)
    cutoff = C.ntz_literal(pushed_before)
    sdim, study, site, subject, visit_def, visit = C.reference_versions(refs, cutoff)
    run = C.ntz_literal(run_time)

    def process(batch: DataFrame, epoch_id: int) -> None:
        if lateness or retry:
            # Of several events of one id the last counts.
            batch = first_per_key(batch, ["event_id"], ["ts"], latest=True)
        ext = RV.extract_changed_visits(C.visits_from_events(batch))
        if retry:
            ext = with_pending(spark, ext, out_dir, epoch_id)
        resolved = RV.resolve_visits(RV.enrich_site(ext, sdim), study, site, subject, visit_def, visit)
        resolved = resolved.persist()          # feeds three writes of this micro-batch
        try:
            target = f"{out_dir}/epoch={epoch_id}"
            outcomes = RV.outcome_rows(resolved, run)
            outcomes.write.mode("overwrite").parquet(f"{target}/log")
            RV.insert_payload(resolved).write.mode("overwrite").parquet(f"{target}/insert")
            RV.update_payload(resolved).write.mode("overwrite").parquet(f"{target}/update")
            if retry:
                failed = resolved.where(F.col("responsestatus") == "FAILURE").select(*RV.EXTRACT_COLUMNS)
                failed.write.mode("overwrite").parquet(f"{out_dir}/pending/epoch={epoch_id}")
            if log_path is not None:
                log = spark.read.parquet(f"{log_path}/epoch={epoch_id - 1}")
                ST.merge_to_next_version(log, spark.read.parquet(f"{target}/log"), f"{log_path}/epoch={epoch_id}",
                                         LOG_KEYS, LOG_UPDATES, "study_key", close_on=VISIT_KEYS)
        finally:
            resolved.unpersist()

    stream = (spark.readStream.schema(EVENTS_SCHEMA)
              .option("pathGlobFilter", file_glob)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(events_dir))
    if lateness:
        timed = stream.withColumn("_at", F.col("ts").cast("timestamp")).withWatermark("_at", lateness)
        stream = timed.dropDuplicatesWithinWatermark(["event_id", "_at"]).drop("_at")
    return (stream.writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


VISIT = ["study_key", "subj_id", "visitid_instanceid"]


def with_pending(spark: SparkSession, ext: DataFrame, out_dir: str, epoch_id: int) -> DataFrame:
    """``ext`` and the visits that were pending after the micro-batch before, one
    row a visit, the batch's if it has one."""
    if epoch_id == 0:
        return ext
    pending = spark.read.schema(ext.schema).parquet(f"{out_dir}/pending/epoch={epoch_id - 1}")
    both = ext.withColumn("_new", F.lit(1)).unionByName(pending.withColumn("_new", F.lit(0)))
    return first_per_key(both, VISIT, ["_new"], latest=True).select(*ext.columns)


def read_sync_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """All outcome rows written so far, with their micro-batch id."""
    return spark.read.option("basePath", out_dir).parquet(f"{out_dir}/epoch=*/log")
