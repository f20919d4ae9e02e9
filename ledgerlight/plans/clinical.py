"""Clinical queries: change windows, watermarks, visit resolution, the
outcome-log MERGE, the sync orchestration and the JSON page ingest."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import resolve as RV
from ..operators import state as ST
from ..operators.joins import first_per_key, join_dim
from ..operators.rank import materialised
from ..sources import clinical as C
from ..sources.tables import Tables
from . import clinical_sql as Q
from .registry import ORACLE, query

# Fixed run parameters of the registered queries (deterministic results).
RUN_TIME = _dt.datetime(2024, 2, 1)
PREVIOUS_RUN = _dt.datetime(2024, 1, 15)
WINDOW_END = _dt.datetime(2024, 1, 20)
ADVANCED_TABLE = "i_click"
SYNC_NAME = "subject_visits"

_WM_SQL = Q.WM


def _watermark(t: Tables) -> _dt.datetime:
    """The stored last-sync time (a scalar read, like any job parameter),
    read once per query build."""
    wm = getattr(t, "_watermark", None)
    if wm is None:
        wm = ST.read_watermark(C.sync_watermark(t), SYNC_NAME, C.DEFAULT_WATERMARK).first()["watermark"]
        t._watermark = wm
    return wm


def _since(t: Tables):
    return C.ntz_literal(_watermark(t))


# ---------------------------------------------------------- change windows

def _windows(t: Tables) -> DataFrame:
    return ST.extraction_windows(C.table_watermarks(t), C.ntz_literal(WINDOW_END))


@query("change_window")
def change_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-table extraction windows from the watermark config (tables
    without a parsable date are skipped), applied to the visits with the
    half-open (lo, hi] created-or-modified test."""
    t = Tables(spark, sf_dir)
    win = _windows(t).select("table_name", "min_ts", "max_ts", "filter")
    v = C.visits(t).withColumn("table_name", F.concat(F.lit("i_"), F.col("studyKey")))
    j = join_dim(v, win, "table_name", "inner")      # a row per source table: small or not, the planner sees
    j = j.where(ST.in_change_window(F.col("dateCreated"), F.col("dateModified"), F.col("min_ts"), F.col("max_ts")))
    return j.groupBy("table_name", "filter").agg(
        F.count(F.lit(1)).alias("n_changed"), F.min("dateCreated").alias("first_created"),
        F.max("dateModified").alias("last_modified"))


_CFG_SQL = """cfg AS (
  SELECT 'i_' || event_type AS table_name,
         CASE WHEN event_type = 'signup' THEN 'not a date' ELSE strftime(min(ts), '%Y-%m-%dT%H:%M:%S') END AS latest
  FROM events GROUP BY event_type),
win AS (
  SELECT table_name, TRY_CAST(latest AS TIMESTAMP) AS min_ts, TIMESTAMP '""" + str(WINDOW_END) + """' AS max_ts
  FROM cfg WHERE TRY_CAST(latest AS TIMESTAMP) IS NOT NULL),
winf AS (
  SELECT *, 'dateCreated>' || strftime(min_ts, '%Y-%m-%dT%H:%M:%SZ') || ' and dateCreated<' || strftime(max_ts, '%Y-%m-%dT%H:%M:%SZ')
         || ' or dateModified>' || strftime(min_ts, '%Y-%m-%dT%H:%M:%SZ') || ' and dateModified<' || strftime(max_ts, '%Y-%m-%dT%H:%M:%SZ') AS filter
  FROM win)"""

ORACLE["change_window"] = Q.with_([Q.VISITS, _CFG_SQL]) + """
SELECT w.table_name, w.filter, count(*) AS n_changed, min(v.dateCreated) AS first_created, max(v.dateModified) AS last_modified
FROM visits v JOIN winf w ON w.table_name = 'i_' || v.studyKey
WHERE (v.dateCreated > w.min_ts AND v.dateCreated <= w.max_ts) OR (v.dateModified > w.min_ts AND v.dateModified <= w.max_ts)
GROUP BY w.table_name, w.filter"""


@query("change_window_excl")
def change_window_excl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in the change window, minus catalog records and new records
    (a NULL type is not the excluded value and is kept)."""
    t = Tables(spark, sf_dir)
    win = _windows(t).select("table_name", "min_ts", "max_ts")
    r = C.records(t).withColumn("table_name", F.concat(F.lit("i_"), F.col("studyKey")))
    j = join_dim(r, win, "table_name", "inner")      # a row per source table: small or not, the planner sees
    keep = (ST.in_change_window(F.col("dateCreated"), F.col("dateModified"), F.col("min_ts"), F.col("max_ts"))
            & ~F.col("recordType").eqNullSafe(F.lit("CATALOG"))
            & ~F.col("recordStatus").eqNullSafe(F.lit("New Record")))
    return j.where(keep).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_kept"),
        F.count(F.when(F.col("recordType").isNull(), F.lit(1))).alias("n_null_type"))


ORACLE["change_window_excl"] = Q.with_([_CFG_SQL, """rec AS (
  SELECT event_type AS studyKey, CASE WHEN event_id % 9 = 0 THEN 'CATALOG' WHEN event_id % 9 = 1 THEN NULL ELSE 'FORM' END AS recordType,
         CASE WHEN event_id % 4 = 0 THEN 'New Record' ELSE 'Record Complete' END AS recordStatus,
         ts AS dateCreated, ts + to_days(CAST(event_id % 5 AS INTEGER)) AS dateModified FROM events)"""]) + """
SELECT w.table_name, count(*) AS n_kept, count(*) FILTER (WHERE r.recordType IS NULL) AS n_null_type
FROM rec r JOIN win w ON w.table_name = 'i_' || r.studyKey
WHERE ((r.dateCreated > w.min_ts AND r.dateCreated <= w.max_ts) OR (r.dateModified > w.min_ts AND r.dateModified <= w.max_ts))
  AND r.recordType IS DISTINCT FROM 'CATALOG' AND r.recordStatus IS DISTINCT FROM 'New Record'
GROUP BY w.table_name"""


@query("since_watermark")
def since_watermark(spark: SparkSession, sf_dir: str, study: str | None = None) -> DataFrame:
    """Visits created or modified at/after the stored last-sync time."""
    t = Tables(spark, sf_dir)
    since = _since(t)
    v = C.visits(t).where(ST.changed_since(F.col("dateCreated"), F.col("dateModified"), since))
    if study is not None:
        v = v.where(F.col("studyKey") == study)
    return v.groupBy("studyKey").agg(F.count(F.lit(1)).alias("n_changed"),
                                     F.min("dateCreated").alias("first_created"),
                                     F.max("dateModified").alias("last_modified"))


ORACLE["since_watermark"] = Q.with_([Q.VISITS]) + f"""
SELECT studyKey, count(*) AS n_changed, min(dateCreated) AS first_created, max(dateModified) AS last_modified
FROM visits WHERE dateCreated >= {_WM_SQL} OR dateModified >= {_WM_SQL} GROUP BY studyKey"""


@query("study_key_union")
def study_key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct, non-null study keys across the visit, subject and study
    tables."""
    t = Tables(spark, sf_dir)
    a = C.visits(t).select(F.col("studyKey").alias("study_key"))
    b = C.subject_dim(t).select(F.col("studyKey").alias("study_key"))
    c = C.study_ref(t).select(F.col("external_id").alias("study_key"))
    return a.union(b).union(c).distinct().where(F.col("study_key").isNotNull())


ORACLE["study_key_union"] = Q.with_([Q.VISITS, Q.SUBJECT_DIM, Q.STUDY]) + """
SELECT study_key FROM (SELECT studyKey AS study_key FROM visits UNION SELECT studyKey FROM sdim
                       UNION SELECT external_id FROM study) WHERE study_key IS NOT NULL"""


@query("visit_site_enrich")
def visit_site_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits per study and how many found their site through the subject
    dimension."""
    t = Tables(spark, sf_dir)
    e = RV.enrich_site(RV.extract_changed_visits(C.visits(t)), C.subject_dim(t))
    return e.groupBy("study_key").agg(F.count(F.lit(1)).alias("n_visits"),
                                      F.count("site_name").alias("n_with_site"))


ORACLE["visit_site_enrich"] = Q.with_([Q.VISITS, Q.SUBJECT_DIM]) + """
SELECT v.studyKey AS study_key, count(*) AS n_visits, count(d.siteName) AS n_with_site
FROM visits v LEFT JOIN sdim d ON v.studyKey = d.studyKey AND v.subjectId = d.subjectId GROUP BY v.studyKey"""


# ------------------------------------------------------------ retry source

RETRY_KEYS = ["study_key", "visit_instance_id"]
# Fixed value: the outcome message of a failed visit whose source row is gone.
MSG_NO_SOURCE = "Source data not found for failed record."


def retry_failures(log: DataFrame) -> DataFrame:
    """One row per failed visit of the log (with the log's subject key)."""
    return (log.where((F.col("responsestatus") == "FAILURE") & (F.col("type") == "SubjectVisit"))
               .groupBy(*RETRY_KEYS).agg(F.min("subjectKey").alias("log_subjectKey")))


def _retry_joined(t: Tables, log: DataFrame) -> DataFrame:
    """Failed visits left-joined to their latest source row.  The source is
    first reduced to the failed visits (a semi join), so only those rows
    are deduplicated, not the whole visit history."""
    failed = retry_failures(log)
    src = C.visits(t).select(F.col("studyKey").alias("study_key"), F.col("visitid_instanceid").alias("visit_instance_id"),
                             "dateModified", "subjectId", "intervalName", "visitDate", "deleted", "subjectKey",
                             "visitType", "ieyn", "source")
    src = src.join(failed.select(*RETRY_KEYS), RETRY_KEYS, "left_semi")
    latest = first_per_key(src, RETRY_KEYS, ["dateModified"], latest=True)
    return failed.join(latest, RETRY_KEYS, "left")


def retry_source(t: Tables, log: DataFrame) -> DataFrame:
    """The retry batch as an extract: failed visits with their latest
    source row and the site of that row's subject."""
    j = _retry_joined(t, log).where(F.col("dateModified").isNotNull())
    j = RV.enrich_site(j.withColumnRenamed("subjectId", "subj_id"), C.subject_dim(t))
    return j.select("study_key", "subj_id", F.col("intervalName").alias("interval_name"),
                    F.col("visit_instance_id").alias("visitid_instanceid"), F.col("visitDate").alias("visit_date"),
                    F.col("deleted").alias("is_deleted"), "subjectKey", F.col("visitType").alias("visit_type"),
                    "ieyn", "source", "site_name")


def retry_without_source(t: Tables, log: DataFrame, run_time) -> DataFrame:
    """Outcome rows for failed visits whose source row no longer exists."""
    j = _retry_joined(t, log).where(F.col("dateModified").isNull())
    return j.select(F.col("log_subjectKey").alias("subjectKey"), "study_key", F.lit(None).cast("string").alias("site_name"),
                    F.lit("FAILURE").alias("responsestatus"), F.lit("insert").alias("method"),
                    F.lit(MSG_NO_SOURCE).alias("error_message"), run_time.alias("inserted_date"),
                    F.lit("SubjectVisit").alias("type"), "visit_instance_id")


@query("failed_retry_source")
def failed_retry_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retry batch: failed log visits with their latest source row and
    site."""
    t = Tables(spark, sf_dir)
    return retry_source(t, C.previous_log(t, PREVIOUS_RUN, _since(t)))


_SITE_MISSING_SQL = Q._msg("Site name missing for study '", ("v.studyKey",), "' and subject '", ("v.subjectKey",), "'")
_PREV_LOG_SQL = f"""plog AS (
  SELECT v.subjectKey, v.studyKey AS study_key, d.siteName AS site_name,
         CASE WHEN coalesce(d.siteName, '') = '' THEN 'FAILURE' ELSE 'SUCCESSFUL' END AS responsestatus,
         'insert' AS method,
         CASE WHEN coalesce(d.siteName, '') = '' THEN {_SITE_MISSING_SQL} END AS error_message,
         TIMESTAMP '{PREVIOUS_RUN}' AS inserted_date, 'SubjectVisit' AS type, v.visitid_instanceid AS visit_instance_id
  FROM visits v LEFT JOIN sdim d ON v.studyKey = d.studyKey AND v.subjectId = d.subjectId
  WHERE v.dateCreated < {_WM_SQL})"""

_RETRY_SQL = """fl AS (
  SELECT study_key, visit_instance_id, min(subjectKey) AS log_subjectKey FROM plog
  WHERE responsestatus = 'FAILURE' AND type = 'SubjectVisit' GROUP BY study_key, visit_instance_id),
srcl AS (
  SELECT studyKey, visitid_instanceid, arg_max(subjectId, dateModified) AS subjectId,
         arg_max(intervalName, dateModified) AS intervalName, arg_max(visitDate, dateModified) AS visitDate,
         arg_max(deleted, dateModified) AS deleted, arg_max(subjectKey, dateModified) AS subjectKey,
         arg_max(visitType, dateModified) AS visitType, arg_max(ieyn, dateModified) AS ieyn,
         arg_max(source, dateModified) AS source
  FROM visits WHERE (studyKey, visitid_instanceid) IN (SELECT study_key, visit_instance_id FROM fl)
  GROUP BY studyKey, visitid_instanceid),
retry AS (
  SELECT fl.study_key, s.subjectId AS subj_id, s.intervalName AS interval_name, fl.visit_instance_id AS visitid_instanceid,
         s.visitDate AS visit_date, s.deleted AS is_deleted, s.subjectKey, s.visitType AS visit_type, s.ieyn, s.source,
         d.siteName AS site_name
  FROM fl JOIN srcl s ON s.studyKey = fl.study_key AND s.visitid_instanceid = fl.visit_instance_id
  LEFT JOIN sdim d ON d.studyKey = fl.study_key AND d.subjectId = s.subjectId),
retry_missing AS (
  SELECT fl.log_subjectKey AS subjectKey, fl.study_key, CAST(NULL AS VARCHAR) AS site_name, 'FAILURE' AS responsestatus,
         'insert' AS method, 'Source data not found for failed record.' AS error_message,
         TIMESTAMP '""" + str(RUN_TIME) + """' AS inserted_date, 'SubjectVisit' AS type, fl.visit_instance_id
  FROM fl LEFT JOIN srcl s ON s.studyKey = fl.study_key AND s.visitid_instanceid = fl.visit_instance_id
  WHERE s.studyKey IS NULL)"""

ORACLE["failed_retry_source"] = Q.with_([Q.VISITS, Q.SUBJECT_DIM, _PREV_LOG_SQL, _RETRY_SQL]) + "SELECT * FROM retry"


# ------------------------------------------------------------- resolution

def changed_batch(t: Tables, study: str | None = None) -> DataFrame:
    """The changed visits since the watermark (optionally of one study),
    enriched with the site."""
    ext = RV.extract_changed_visits(C.visits(t), since=_since(t), study=study)
    return RV.enrich_site(ext, C.subject_dim(t))


def resolve(t: Tables, batch: DataFrame) -> DataFrame:
    _, study, site, subject, visit_def, visit = C.reference_versions(t, _since(t))
    return RV.resolve_visits(batch, study, site, subject, visit_def, visit)


def resolved_batch(t: Tables) -> DataFrame:
    """The changed batch resolved, over written visits and references."""
    C.reference_versions(t, _since(t))
    return resolve(t, changed_batch(t))


def earlier_log(t: Tables) -> DataFrame:
    """The earlier run's log, materialised: a merge uses it several times."""
    C.reference_versions(t, _since(t))
    return t.memo("earlier_log", lambda: materialised(C.previous_log(t, PREVIOUS_RUN, _since(t))))


RESOLVE_COLS = ["study_key", "visitid_instanceid", "study_id", "study_ext", "external_id", "site_id", "country_id",
                "subject_id", "category", "visitdef_id", "target_visit_id", "visit_date_iso", "visit_status",
                "method", "responsestatus", "error_message"]


@query("visit_resolve")
def visit_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changed batch resolved: ids, category, status, first failing
    validation and insert/update method."""
    return resolved_batch(Tables(spark, sf_dir)).select(*RESOLVE_COLS)


_BATCH_WHERE = f"dateCreated >= {_WM_SQL} OR dateModified >= {_WM_SQL}"
ORACLE["visit_resolve"] = Q.with_(Q.resolve_ctes(_BATCH_WHERE)) + "SELECT " + ", ".join(RESOLVE_COLS) + " FROM res"


@query("visit_errors")
def visit_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First failing validation per visit, counted per study and message."""
    r = resolved_batch(Tables(spark, sf_dir)).where(F.col("error_message").isNotNull())
    return r.groupBy("study_key", "error_message").agg(F.count(F.lit(1)).alias("n_visits"))


ORACLE["visit_errors"] = Q.with_(Q.resolve_ctes(_BATCH_WHERE)) + """
SELECT study_key, error_message, count(*) AS n_visits FROM res WHERE error_message IS NOT NULL
GROUP BY study_key, error_message"""


@query("visit_upsert_split")
def visit_upsert_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outbound payloads: the insert set (nine fields) and the update set
    (three fields and the target id), counted per status."""
    r = materialised(resolved_batch(Tables(spark, sf_dir)))
    ins = RV.insert_payload(r).select(F.lit("insert").alias("method"), F.col("visit_status__v").alias("visit_status"),
                                      F.col("external_id__v").alias("k"))
    upd = RV.update_payload(r).select(F.lit("update").alias("method"), F.col("visit_status__v").alias("visit_status"),
                                      F.col("id").alias("k"))
    return ins.unionByName(upd).groupBy("method", "visit_status").agg(
        F.count(F.lit(1)).alias("n_payloads"), F.count_distinct("k").alias("n_targets"))


ORACLE["visit_upsert_split"] = Q.with_(Q.resolve_ctes(_BATCH_WHERE)) + """
SELECT method, visit_status, count(*) AS n_payloads,
       count(DISTINCT CASE WHEN method = 'insert' THEN external_id ELSE target_visit_id END) AS n_targets
FROM res WHERE responsestatus = 'SUCCESSFUL' GROUP BY method, visit_status"""


@query("visit_insert_payload", Q.with_(Q.resolve_ctes(_BATCH_WHERE)) + """
SELECT external_id AS external_id__v, study_id AS study__v, site_id AS site__v, subject_id AS subject__v,
       country_id AS study_country__v, visit_date_iso AS visit_date__v, visitdef_id AS visit_def__v,
       visit_status AS visit_status__v, 'active__c' AS reporting_status__c
FROM res WHERE responsestatus = 'SUCCESSFUL' AND method = 'insert'""")
def visit_insert_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine fields of every visit to insert."""
    return RV.insert_payload(resolved_batch(Tables(spark, sf_dir)))


@query("visit_update_payload", Q.with_(Q.resolve_ctes(_BATCH_WHERE)) + """
SELECT target_visit_id AS id, visit_date_iso AS visit_date__v, visitdef_id AS visit_def__v, visit_status AS visit_status__v
FROM res WHERE responsestatus = 'SUCCESSFUL' AND method = 'update'""")
def visit_update_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of every visit to update, with its target id."""
    return RV.update_payload(resolved_batch(Tables(spark, sf_dir)))


# ----------------------------------------------------------- outcome log

LOG_KEYS = ["subjectKey", "study_key", "visit_instance_id", "method"]
LOG_UPDATES = ["responsestatus", "error_message", "inserted_date"]
VISIT_KEYS = LOG_KEYS[:3]


@query("log_merge")
def log_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MERGE the batch's outcome rows into the previous log on (subject,
    study, visit, method), NULL-safe; a success closes the visit's failures
    of every method."""
    t = Tables(spark, sf_dir)
    batch = materialised(RV.outcome_rows(resolved_batch(t), C.ntz_literal(RUN_TIME)))
    return ST.merge_upsert(earlier_log(t), batch, LOG_KEYS, LOG_UPDATES, close_on=VISIT_KEYS)


def _merge_sql(src: str) -> str:
    keys = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in LOG_KEYS)
    cols = ["subjectKey", "study_key", "site_name", "responsestatus", "method", "error_message", "inserted_date",
            "type", "visit_instance_id"]
    sel = ", ".join((f"CASE WHEN s._in IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" if c in LOG_UPDATES else
                     f"CASE WHEN t._in IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}") for c in cols)
    visit = " AND ".join(f"p.{k} IS NOT DISTINCT FROM w.{k}" for k in VISIT_KEYS)
    closed = "w.won AND p.responsestatus = 'FAILURE'"
    plog = (f"SELECT p.* REPLACE (CASE WHEN {closed} THEN 'SUCCESSFUL' ELSE p.responsestatus END AS responsestatus, "
            f"CASE WHEN {closed} THEN NULL ELSE p.error_message END AS error_message, "
            f"CASE WHEN {closed} THEN TIMESTAMP '{RUN_TIME}' ELSE p.inserted_date END AS inserted_date), TRUE AS _in "
            f"FROM plog p LEFT JOIN (SELECT DISTINCT {', '.join(VISIT_KEYS)}, TRUE AS won FROM {src} WHERE responsestatus = 'SUCCESSFUL') w ON {visit}")
    return (f"SELECT {sel} FROM ({plog}) t "
            f"FULL OUTER JOIN (SELECT *, TRUE AS _in FROM {src}) s ON {keys}")


_OUTCOME_SQL = f"""outc AS (
  SELECT subjectKey, study_key, site_name, responsestatus, method, error_message,
         TIMESTAMP '{RUN_TIME}' AS inserted_date, 'SubjectVisit' AS type, visitid_instanceid AS visit_instance_id FROM res)"""
ORACLE["log_merge"] = Q.with_(Q.resolve_ctes(_BATCH_WHERE) + [_PREV_LOG_SQL, _OUTCOME_SQL]) + _merge_sql("outc")


LOG_FILES = 16


@query("log_merge_files", ORACLE["log_merge"])
def log_merge_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same MERGE into a log kept as versions of files ranged by visit: only files
    that hold a visit of the batch are written anew, the list carries the others on, and
    the batch, merged again, changes nothing."""
    from ..session import scratch_path
    from ..sources import versions as V
    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "log-versions")
    V.overwrite(spark, root, earlier_log(t).repartitionByRange(LOG_FILES, "visit_instance_id", "subjectKey"), "earlier run")
    batch = materialised(RV.outcome_rows(resolved_batch(t), C.ntz_literal(RUN_TIME)))
    for _ in range(2):
        V.merge(spark, root, batch, LOG_KEYS, LOG_UPDATES, f"run {RUN_TIME}", close_on=VISIT_KEYS)
    return V.read(spark, root)


@query("sync_visits_log")
def sync_visits_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental sync: retry the failed visits of the log, then the
    visits changed since the watermark; all outcomes are MERGEd into the
    log (for a visit in both sets the later, changed-batch outcome wins)."""
    t = Tables(spark, sf_dir)
    log = earlier_log(t)
    outcomes = _sync_outcomes(t, log, sync_batch(t, log), C.ntz_literal(RUN_TIME))
    return ST.merge_upsert(log, outcomes, LOG_KEYS, LOG_UPDATES, close_on=VISIT_KEYS)


def sync_batch(t: Tables, log: DataFrame, successes: Observation | None = None) -> DataFrame:
    """The retried and the changed visits through one resolution (it is row
    by row independent), materialised; ``_seq`` 0 and 1.  ``successes`` takes the
    number of visits that went through, from the same job."""
    retry = retry_source(t, log).withColumn("_seq", F.lit(0))
    batch = changed_batch(t).withColumn("_seq", F.lit(1))
    resolved = resolve(t, retry.unionByName(batch))
    return materialised(resolved.observe(successes, success_count()) if successes is not None else resolved)


def _sync_outcomes(t: Tables, log: DataFrame, resolved: DataFrame, run) -> DataFrame:
    """One materialised outcome row per log key; the changed batch's wins."""
    rows = RV.outcome_rows(resolved, run, keep=("_seq",))
    rows = rows.unionByName(retry_without_source(t, log, run).withColumn("_seq", F.lit(0)))
    one = first_per_key(rows, LOG_KEYS, ["_seq"], latest=True).drop("_seq")
    return materialised(one.select(*log.columns))


@query("watermark_advance")
def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advance one table's watermark to the batch's last modification,
    only when the batch had at least one successful visit."""
    from ..sources import sinks as K
    t = Tables(spark, sf_dir)
    dims = C.reference_versions(t, _since(t))
    # The counts come with the write of the batch's outcomes; nothing is read again for them.
    last, done = Observation("last change"), Observation("successes")
    changed = (C.visits(t).where(ST.changed_since(F.col("dateCreated"), F.col("dateModified"), _since(t)))
               .observe(last, F.date_format(F.max("dateModified"), "yyyy-MM-dd HH:mm:ss").alias("m")))
    batch = RV.enrich_site(RV.extract_changed_visits(changed), dims[0])
    outcomes = RV.outcome_rows(resolve(t, batch), C.ntz_literal(RUN_TIME)).observe(done, success_count())
    K.write_version(outcomes, spark, "batch-outcomes")
    return ST.advance_table_watermark(C.table_watermarks(t), ADVANCED_TABLE, F.lit(last.get["m"]),
                                      success_count=F.lit(int(done.get["ok"])))


def success_count() -> Column:
    """Visits that went through (an aggregate, to observe)."""
    return F.count(F.when(F.col("responsestatus") == "SUCCESSFUL", F.lit(1))).alias("ok")


ORACLE["watermark_advance"] = Q.with_(Q.resolve_ctes(_BATCH_WHERE) + ["""cfg AS (
  SELECT 'i_' || event_type AS "Table",
         CASE WHEN event_type = 'signup' THEN 'not a date' ELSE strftime(min(ts), '%Y-%m-%dT%H:%M:%S') END AS latest
  FROM events GROUP BY event_type)""", f"""st2 AS (
  SELECT (SELECT count(*) FROM res WHERE responsestatus = 'SUCCESSFUL') AS ok,
         (SELECT strftime(max(dateModified), '%Y-%m-%d %H:%M:%S') FROM visits WHERE {_BATCH_WHERE}) AS m)"""]) + f"""
SELECT "Table", CASE WHEN "Table" = '{ADVANCED_TABLE}' AND ok >= 1 THEN m ELSE latest END AS "Latest_Date" FROM cfg, st2"""


@query("run_log")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Execution-log rows, one per study table loaded by the batch."""
    t = Tables(spark, sf_dir)
    v = C.visits(t).where(ST.changed_since(F.col("dateCreated"), F.col("dateModified"), _since(t)))
    per = v.groupBy(F.concat(F.lit("i_"), F.col("studyKey")).alias("table")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("dateCreated").alias("start_time"),
        F.max("dateModified").alias("end_time"))
    return ST.run_log(per, layer="Bronze", data_source="visits")


ORACLE["run_log"] = Q.with_([Q.VISITS]) + f"""
SELECT 'i_' || studyKey AS "table", 'ETL' AS log_type, 'Success' AS etl_status, 'Bronze' AS layer,
       'visits' AS data_source, CAST(NULL AS VARCHAR) AS error, CAST(200 AS INTEGER) AS status_code,
       count(*) AS row_count, min(dateCreated) AS start_time, max(dateModified) AS end_time,
       CASE WHEN count(*) > 0 THEN 'API Execution' ELSE 'No data available' END AS custom_description
FROM visits WHERE {_BATCH_WHERE} GROUP BY studyKey"""


def _sync_oracle() -> str:
    keys = ", ".join(LOG_KEYS)
    ctes = (Q.resolve_ctes(_BATCH_WHERE) + [_PREV_LOG_SQL, _OUTCOME_SQL, _RETRY_SQL] + Q.resolve_chain("r_", "retry")
            + [f"""routc AS (
  SELECT subjectKey, study_key, site_name, responsestatus, method, error_message,
         TIMESTAMP '{RUN_TIME}' AS inserted_date, 'SubjectVisit' AS type, visitid_instanceid AS visit_instance_id FROM r_res)""",
               f"""allo AS (SELECT *, 0 AS seq FROM routc UNION ALL SELECT *, 0 AS seq FROM retry_missing
                 UNION ALL SELECT *, 1 AS seq FROM outc)""",
               f"""pick AS (SELECT * EXCLUDE (seq) FROM allo
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY seq DESC) = 1)"""])
    return Q.with_(ctes) + _merge_sql("pick")


ORACLE["sync_visits_log"] = _sync_oracle()


# ------------------------------------------------- the sync as a stream

@query("streaming_visit_sync")
def streaming_visit_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the Structured Streaming sync over the landed events file
    (availableNow: drain and stop) and return the outcome log it wrote."""
    from ..session import scratch_path
    from ..streaming.visit_sync import read_sync_log, start_visit_sync
    t = Tables(spark, sf_dir)
    out = scratch_path(spark, "visit-sync-out")
    q = start_visit_sync(spark, sf_dir, sf_dir, out, scratch_path(spark, "visit-sync-ckpt"), RUN_TIME,
                         pushed_before=_watermark(t), file_glob="events.parquet")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_sync_log(spark, out).drop("epoch")


ORACLE["streaming_visit_sync"] = Q.with_(Q.resolve_ctes("TRUE")) + f"""
SELECT subjectKey, study_key, site_name, responsestatus, method, error_message,
       TIMESTAMP '{RUN_TIME}' AS inserted_date, 'SubjectVisit' AS type, visitid_instanceid AS visit_instance_id FROM res"""


@query("streaming_visit_sync_replayed", ORACLE["streaming_visit_sync"])
def streaming_visit_sync_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream over events that are landed twice, the second time in another order
    and file: state drops the replays, so each event is in the log once."""
    from ..session import scratch_path
    from ..streaming.visit_sync import read_sync_log, start_visit_sync
    t = Tables(spark, sf_dir)
    landed, out = scratch_path(spark, "landed-events"), scratch_path(spark, "visit-sync-out")
    t.events.write.parquet(f"{landed}/first")
    t.events.sortWithinPartitions(F.col("event_id").desc()).write.parquet(f"{landed}/again")
    # Each landing is one micro-batch, however many files it has: the reference tables are joined once a batch.
    files = max(1, len(spark.read.parquet(f"{landed}/first").inputFiles()))
    # A span that holds the whole history: all of it is replayed.
    q = start_visit_sync(spark, f"{landed}/*", sf_dir, out, scratch_path(spark, "visit-sync-ckpt"), RUN_TIME, pushed_before=_watermark(t),
                         file_glob="*.parquet", max_files_per_trigger=files, lateness="3650 days")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_sync_log(spark, out).drop("epoch")


# ------------------------------------------- delete by predicate, paging

PURGED_STUDY = "error"
PAGE_LIMIT, PAGE_OFFSET = 1000, 1000


@query("log_purge_study")
def log_purge_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier log without one study's rows: a DELETE ... WHERE as a
    filtered rewrite (the caller writes it as a new version)."""
    t = Tables(spark, sf_dir)
    return ST.delete_where(C.previous_log(t, PREVIOUS_RUN, _since(t)), F.col("study_key") == PURGED_STUDY)


ORACLE["log_purge_study"] = Q.with_([Q.VISITS, Q.SUBJECT_DIM, _PREV_LOG_SQL]) + f"""
SELECT * FROM plog WHERE NOT coalesce(study_key = '{PURGED_STUDY}', FALSE)"""


@query("visit_page")
def visit_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page (limit/offset over a total order) of the resolved batch --
    the paged listing of a lookup API; the limit is the feature."""
    from ..sources.params import page_of
    r = resolved_batch(Tables(spark, sf_dir)).select("study_key", "visitid_instanceid", "external_id", "responsestatus")
    return page_of(r, ["study_key", F.col("visitid_instanceid").cast("long")], PAGE_LIMIT, PAGE_OFFSET)


ORACLE["visit_page"] = Q.with_(Q.resolve_ctes(_BATCH_WHERE)) + f"""
SELECT study_key, visitid_instanceid, external_id, responsestatus FROM res
ORDER BY study_key, CAST(visitid_instanceid AS BIGINT) LIMIT {PAGE_LIMIT} OFFSET {PAGE_OFFSET}"""


#: Offsets of the pages that are sought; the last lies beyond the listing.
SEEK_OFFSETS = (0, PAGE_OFFSET, 777, 10 ** 9)


@query("visit_pages_by_seek", Q.with_(Q.resolve_ctes(_BATCH_WHERE) + [
    "listing AS (SELECT study_key, visitid_instanceid, external_id, responsestatus, "
    "row_number() OVER (ORDER BY study_key, CAST(visitid_instanceid AS BIGINT)) - 1 AS place FROM res)",
    "o AS (SELECT unnest([" + ", ".join(str(x) for x in SEEK_OFFSETS) + "]) AS page_offset)"]) + f"""
SELECT CAST(page_offset AS BIGINT) AS page_offset, place, study_key, visitid_instanceid, external_id, responsestatus
FROM o JOIN listing ON place >= page_offset AND place < page_offset + {PAGE_LIMIT}""")
def visit_pages_by_seek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several pages of the resolved batch's listing, ordered and written once; each page
    reads only the ranges that it lies in."""
    from ..operators.paging import write_paged
    r = resolved_batch(Tables(spark, sf_dir)).select("study_key", "visitid_instanceid", "external_id", "responsestatus")
    paged = write_paged(r, ["study_key", F.col("visitid_instanceid").cast("long")])
    pages = [paged.page(PAGE_LIMIT, o, at="place").withColumn("page_offset", F.lit(o).cast("long")) for o in SEEK_OFFSETS]
    out = pages[0]
    for p in pages[1:]:
        out = out.unionByName(p)
    return out.select("page_offset", "place", "study_key", "visitid_instanceid", "external_id", "responsestatus")


@query("visit_date_parse")
def visit_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit-date text in either accepted layout -> ISO date; empty or
    unparsable text -> NULL."""
    from ..functions.dates import iso_date_from_two_formats
    v = C.visits(Tables(spark, sf_dir))
    return v.select(F.col("studyKey").alias("study_key"), "visitid_instanceid", F.col("visitDate").alias("visit_date"),
                    iso_date_from_two_formats(F.col("visitDate")).alias("visit_date_iso"))


ORACLE["visit_date_parse"] = Q.with_([Q.VISITS]) + f"""
SELECT studyKey AS study_key, visitid_instanceid, visitDate AS visit_date,
       CASE WHEN coalesce(visitDate, '') <> '' THEN {Q.ISO_DATE.replace('visit_date', 'visitDate')} END AS visit_date_iso
FROM visits"""


# ------------------------------------------- the sync's own tables

EMPTIED = "emptied"


def state_history(spark: SparkSession, marks: str, logs: str, outcomes: DataFrame, run: _dt.datetime) -> None:
    """One run on the sync's two tables of versions: the single-row watermark, created with its
    default on first use and advanced only if a visit of ``outcomes`` went through, and the
    outcome log, created by its first append. Successes are counted while the log is written.
    Each step is a version named after its batch: a run repeated adds none."""
    from ..sources import versions as V
    if V.current(spark, marks) is None:
        default = spark.range(1).select(F.lit(SYNC_NAME).alias("table_name"), C.ntz_literal(C.DEFAULT_WATERMARK).alias("last_sync"))
        V.overwrite(spark, marks, default, "default")
    if V.holding(spark, marks, f"run {run}") is None:
        done = Observation("successes of the run")
        if V.holding(spark, logs, f"run {run}") is None:
            V.append(spark, logs, outcomes.observe(done, success_count()), f"run {run}")
            ok = int(done.get["ok"])
        else:       # ended between the log and the watermark
            ok = V.read(spark, logs, V.holding(spark, logs, f"run {run}")).agg(success_count()).first()["ok"]
        V.overwrite(spark, marks, ST.advance_sync_watermark(V.read(spark, marks), SYNC_NAME, C.ntz_literal(run), F.lit(ok)), f"run {run}")


@query("sync_state_history")
def sync_state_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of the sync's two tables over a first run, a run without a success, and
    the emptying of the log: rows, successes and latest time, all read from the versions."""
    from functools import reduce

    from ..session import scratch_path
    from ..sources import versions as V
    log = earlier_log(Tables(spark, sf_dir))
    marks, logs = scratch_path(spark, "last-sync"), scratch_path(spark, "outcome-log")
    for _ in range(2):                                               # repeated, it changes nothing
        state_history(spark, marks, logs, log, PREVIOUS_RUN)
    state_history(spark, marks, logs, log.where("responsestatus = 'FAILURE'"), RUN_TIME)
    V.overwrite(spark, logs, ST.truncate(V.read(spark, logs)), EMPTIED)

    def rows(table: str, root: str, ok, latest: str) -> list[DataFrame]:
        found = [V.version(spark, root, n) for n in V.versions(spark, root)]
        return [V.read(spark, root, v).agg(F.count(F.lit(1)).alias("n_rows"), ok, F.max(latest).alias("latest"))
                .select(F.lit(table).alias("state"), F.lit(v.number).alias("version"), F.lit(v.batch).alias("batch"), "*") for v in found]

    return reduce(DataFrame.unionByName, rows(SYNC_NAME, marks, F.lit(None).cast("long").alias("ok"), "last_sync") +
                  rows("outcome_log", logs, success_count(), "inserted_date"))


ORACLE["sync_state_history"] = Q.with_([Q.VISITS, Q.SUBJECT_DIM, _PREV_LOG_SQL, """n AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE responsestatus = 'SUCCESSFUL') AS ok, count(*) FILTER (WHERE responsestatus = 'FAILURE') AS bad,
         max(inserted_date) AS latest FROM plog)"""]) + f"""
SELECT '{SYNC_NAME}' AS state, 1 AS version, 'default' AS batch, 1 AS n_rows, CAST(NULL AS BIGINT) AS ok, TIMESTAMP '{C.DEFAULT_WATERMARK}' AS latest
UNION ALL SELECT '{SYNC_NAME}', 2, 'run {PREVIOUS_RUN}', 1, NULL, CASE WHEN ok >= 1 THEN TIMESTAMP '{PREVIOUS_RUN}' ELSE TIMESTAMP '{C.DEFAULT_WATERMARK}' END FROM n
UNION ALL SELECT '{SYNC_NAME}', 3, 'run {RUN_TIME}', 1, NULL, CASE WHEN ok >= 1 THEN TIMESTAMP '{PREVIOUS_RUN}' ELSE TIMESTAMP '{C.DEFAULT_WATERMARK}' END FROM n
UNION ALL SELECT 'outcome_log', 1, 'run {PREVIOUS_RUN}', n, ok, latest FROM n
UNION ALL SELECT 'outcome_log', 2, 'run {RUN_TIME}', n + bad, ok, latest FROM n
UNION ALL SELECT 'outcome_log', 3, '{EMPTIED}', 0, 0, NULL"""


# ----------------------------------------------------- the sync as a job

def run_sync(spark: SparkSession, sf_dir: str, run_time: _dt.datetime = RUN_TIME) -> dict:
    """Run one incremental sync and write its outputs as new versions under
    the shared checkpoint folder: the insert / update payload tables, the
    merged outcome log, and the next last-sync table (advanced to the run's
    start only when at least one visit succeeded).  Returns the paths and
    the success count.  Every output is a fresh folder; nothing is
    overwritten in place."""
    from ..sources import sinks as K
    t = Tables(spark, sf_dir)
    log = earlier_log(t)
    run = C.ntz_literal(run_time)
    # Resolved once, used by four writes; the job that does it counts the successes.
    successes = Observation("successes")
    resolved = sync_batch(t, log, successes)
    payloads = K.write_payloads(RV.insert_payload(resolved), RV.update_payload(resolved), spark)
    merged = ST.merge_upsert(log, _sync_outcomes(t, log, resolved, run), LOG_KEYS, LOG_UPDATES, close_on=VISIT_KEYS)
    log_path = K.write_version(merged, spark, "outcome-log")
    ok = int(successes.get["ok"])
    nxt = ST.advance_sync_watermark(C.sync_watermark(t), SYNC_NAME, run, F.lit(ok))
    wm_path = K.write_version(nxt, spark, "last-sync")
    return {"payloads": payloads, "log": log_path, "last_sync": wm_path, "successes": ok}
