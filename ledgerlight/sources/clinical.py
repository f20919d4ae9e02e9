"""Clinical study-visit tables derived from the driver tables.

Mapping (fixed for the whole library):

  visits        events: study_key = event_type, subject_id = user_id,
                subject_key = 'S-' + 4-digit user_id, visit instance =
                event_id, interval = 'Visit ' + (event_id % 6 + 1),
                created = ts, modified = ts + (event_id % 5) days; the visit
                date text alternates between the micro-second format, the
                second format and NULL; deleted flag, visit type and ieyn
                cycle through '1'/'true'/'True'/'0'/NULL, 'usv'/''/NULL and
                'No'/'yes'/NULL; source is 'medidata' for click, view and
                purchase studies
  subject dim   distinct (study, subject) of the visits ⋈ customer: the site
                name is a long descriptive name (over 50 characters), NULL
                for customers with a negative balance
  resolver      study / site / subject / visit-definition / visit reference
                tables derived from the same rows: the 'purchase' study only
                exists with a '(Prod)' suffix, 'signup' does not exist, sites
                of nation 7 lack a country, sites of nation 13 are not set
                up, customers of nation 11 are not registered as subjects,
                'Visit 6' has no definition by name; subjects and visits exist in the target system when
                they were created before the last sync (an earlier run pushed
                them), so later ones are inserts or missing subjects
  outcome log   the earlier run's log over the visits created before the
                last sync: those without a site failed
  config        per-table and single-row watermark tables

All tables are lazy DataFrames over the given parquet files, so their
size follows the data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Tables

MEDIDATA_STUDIES = ("click", "view", "purchase")
PROD_SUFFIX_STUDIES = ("purchase",)
ABSENT_STUDIES = ("signup",)
NO_COUNTRY_NATION = 7
UNSET_SITE_NATION = 13          # sites there are not set up in the target
UNREGISTERED_NATION = 11        # subjects of customers there are not registered
UNDEFINED_INTERVAL = "Visit 6"
DEFAULT_WATERMARK = _dt.datetime(2023, 10, 2)


def visits(t: Tables) -> DataFrame:
    return t.memo("visits", lambda: visits_from_events(t.events))


def write_visits(t: Tables) -> DataFrame:
    """The visits as a written version: all further plans of ``t`` read it, and
    the events only this once."""
    if "visits_version" not in t._frames:
        from . import sinks as K
        path = K.write_version(visits(t), t.spark, "visits")
        t._frames["visits_version"] = t._frames["visits"] = t.spark.read.schema(visits(t).schema).parquet(path)
    return t._frames["visits"]


def reference_versions(t: Tables, cutoff: F.Column) -> tuple[DataFrame, ...]:
    """(subject dim, study, site, subject, visit definition, visit reference),
    each written once and read back: a resolution joins plain tables."""
    def build():
        from . import sinks as K
        write_visits(t)

        def version(df: DataFrame, name: str) -> DataFrame:
            return t.spark.read.schema(df.schema).parquet(K.write_version(df, t.spark, name))

        t._frames["subject_dim"] = version(_subject_dim(t), "subject-dim")
        return (t._frames["subject_dim"], version(study_ref(t), "study-ref"), version(site_ref(t), "site-ref"),
                version(subject_ref(t, cutoff), "subject-ref"), version(visit_def_ref(t), "visit-def-ref"),
                version(visit_ref(t, cutoff), "visit-ref"))

    return t.memo("reference_versions", build)


def visits_from_events(e: DataFrame) -> DataFrame:
    """The visit derivation on any frame with the events columns (a table
    or a streaming micro-batch)."""
    eid = F.col("event_id")
    m3, m20, m7, m11 = eid % 3, eid % 20, eid % 7, eid % 11
    return e.select(
        F.col("event_type").alias("studyKey"),
        F.col("user_id").cast("string").alias("subjectId"),
        F.concat(F.lit("Visit "), (eid % 6 + 1).cast("string")).alias("intervalName"),
        eid.cast("string").alias("visitid_instanceid"),
        F.when(m3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
         .when(m3 == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("visitDate"),
        F.when(m20 == 0, "1").when(m20 == 10, "true").when(m20 == 5, "True").when(m20 == 15, F.lit(None))
         .otherwise("0").alias("deleted"),
        F.concat(F.lit("S-"), F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("subjectKey"),
        F.when(m7 == 0, "usv").when(m7 == 1, "").alias("visitType"),
        F.when(m11 == 0, "No").when(m11 == 1, "yes").alias("ieyn"),
        F.when(F.col("event_type").isin(*MEDIDATA_STUDIES), "medidata").otherwise("other").alias("source"),
        F.col("ts").alias("dateCreated"),
        F.timestamp_add("DAY", (eid % 5).cast("int"), F.col("ts")).alias("dateModified"),
    )


def subject_dim(t: Tables) -> DataFrame:
    return t.memo("subject_dim", lambda: _subject_dim(t))


def _subject_dim(t: Tables) -> DataFrame:
    pairs = visits(t).select("studyKey", F.col("subjectId").cast("long").alias("uid")).distinct()
    cust = t.customer.select(F.col("c_custkey").alias("uid"), "c_name", "c_mktsegment", "c_acctbal", "c_nationkey")
    nat = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    site = F.concat_ws(" ", "c_name", F.lit("clinical research site"), "c_mktsegment", F.lit("nation"), "n_name")
    # nation: 25 rows (code table); customer grows with the data -> no hint.
    return (pairs.join(cust, "uid", "left").join(F.broadcast(nat), "c_nationkey", "left")
            .select("studyKey", F.col("uid").cast("string").alias("subjectId"),
                    F.when(F.col("c_acctbal") >= 0, site).alias("siteName")))


def _study_ext(study: F.Column) -> F.Column:
    return F.when(study.isin(*PROD_SUFFIX_STUDIES), F.concat(study, F.lit("(Prod)"))).otherwise(study)


def study_ref(t: Tables) -> DataFrame:
    s = visits(t).select(F.col("studyKey").alias("st")).distinct().where(~F.col("st").isin(*ABSENT_STUDIES))
    return s.select(F.concat(F.lit("STU-"), F.upper("st")).alias("id"), F.initcap("st").alias("name"),
                    _study_ext(F.col("st")).alias("external_id"))


def site_ref(t: Tables) -> DataFrame:
    d = subject_dim(t).where(F.col("siteName").isNotNull())
    cust = t.customer.select(F.col("c_custkey").cast("string").alias("subjectId"), "c_nationkey")
    nat = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    x = d.join(cust, "subjectId", "left").join(F.broadcast(nat), "c_nationkey", "left")   # 25 nations
    x = x.where(~F.col("c_nationkey").eqNullSafe(F.lit(UNSET_SITE_NATION)))
    return x.select(F.concat(F.lit("SITE-"), F.col("studyKey"), F.lit("-"), F.col("subjectId")).alias("id"),
                    F.concat(F.lit("STU-"), F.upper("studyKey")).alias("study"),
                    F.substring("siteName", 1, 50).alias("external_id"),
                    F.when(F.col("c_nationkey") != NO_COUNTRY_NATION, F.concat(F.lit("CTRY-"), F.col("n_name")))
                     .alias("study_country"))


def subject_ref(t: Tables, cutoff: F.Column) -> DataFrame:
    """Subjects pushed by earlier runs: those with a visit created before
    ``cutoff``."""
    v = (visits(t).where(F.col("dateCreated") < cutoff)
         .select(F.col("studyKey").alias("event_type"), F.col("subjectId").cast("long").alias("user_id")).distinct())
    unregistered = t.customer.where(F.col("c_nationkey") == UNREGISTERED_NATION).select(
        F.col("c_custkey").alias("user_id"))
    v = v.join(unregistered, "user_id", "left_anti")
    key = F.concat(F.lit("S-"), F.lpad(F.col("user_id").cast("string"), 4, "0"))
    return v.select(F.concat(F.lit("SUB-"), F.col("event_type"), F.lit("-"), F.col("user_id").cast("string")).alias("id"),
                    F.concat(_study_ext(F.col("event_type")), F.lit("-"), key).alias("external_id"))


def visit_def_ref(t: Tables) -> DataFrame:
    v = visits(t).select("studyKey", "intervalName").distinct()
    return v.select(
        F.concat(F.lit("VD-"), F.col("studyKey"), F.lit("-"), F.regexp_replace("intervalName", " ", "")).alias("id"),
        F.concat(F.lit("STU-"), F.upper("studyKey")).alias("study"),
        F.when(F.col("intervalName") != UNDEFINED_INTERVAL, F.col("intervalName")).alias("name"),
        F.concat(_study_ext(F.col("studyKey")), F.lit("-"), F.col("intervalName"), F.lit("-SF")).alias("external_id"))


def visit_ref(t: Tables, cutoff: F.Column) -> DataFrame:
    """Visits pushed by earlier runs: those created before ``cutoff``."""
    v = visits(t).where(F.col("dateCreated") < cutoff)
    return v.select(F.concat(F.lit("VIS-"), F.col("visitid_instanceid")).alias("id"),
                    F.concat_ws("-", _study_ext(F.col("studyKey")), F.col("subjectKey"),
                                F.col("visitid_instanceid")).alias("external_id"))


LOG_SCHEMA = ("subjectKey string, study_key string, site_name string, responsestatus string, method string, "
              "error_message string, inserted_date timestamp_ntz, type string, visit_instance_id string")


def previous_log(t: Tables, run_time: _dt.datetime, cutoff: F.Column) -> DataFrame:
    """The earlier run's outcome log over the visits created before
    ``cutoff``: a visit without a site name failed, the others succeeded."""
    from ..operators.resolve import msg_site_missing
    v = visits(t).where(F.col("dateCreated") < cutoff).join(subject_dim(t), ["studyKey", "subjectId"], "left")
    failed = F.coalesce(F.col("siteName"), F.lit("")) == ""
    return v.select(
        "subjectKey", F.col("studyKey").alias("study_key"), F.col("siteName").alias("site_name"),
        F.when(failed, "FAILURE").otherwise("SUCCESSFUL").alias("responsestatus"),
        F.lit("insert").alias("method"),
        F.when(failed, msg_site_missing(F.col("studyKey"), F.col("subjectKey"))).alias("error_message"),
        ntz_literal(run_time).alias("inserted_date"),
        F.lit("SubjectVisit").alias("type"),
        F.col("visitid_instanceid").alias("visit_instance_id"))


def table_watermarks(t: Tables) -> DataFrame:
    """Per-table watermark config (Table, Latest_Date as ISO text); one
    table per study, its watermark the study's first change, and one row
    with an unparsable date."""
    e = t.events.groupBy("event_type").agg(F.min("ts").alias("m"))
    return e.select(F.concat(F.lit("i_"), F.col("event_type")).alias("Table"),
                    F.when(F.col("event_type") == "signup", F.lit("not a date"))
                     .otherwise(F.date_format("m", "yyyy-MM-dd'T'HH:mm:ss")).alias("Latest_Date"))


def sync_watermark(t: Tables) -> DataFrame:
    """Single-row last-sync table: midnight 15 days after the first visit."""
    e = t.events.agg(F.to_date(F.min("ts")).alias("lo"))
    return e.select(F.lit("subject_visits").alias("table_name"),
                    F.timestamp_add("DAY", F.lit(15), F.col("lo").cast("timestamp_ntz")).alias("last_sync"))


def ntz_literal(ts: _dt.datetime) -> F.Column:
    """A wall-clock timestamp literal independent of the session time zone."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def records(t: Tables) -> DataFrame:
    """Form records: type CATALOG / NULL / FORM and status 'New Record' /
    'Record Complete' cycle over the events."""
    eid = F.col("event_id")
    return t.events.select(
        F.col("event_type").alias("studyKey"), eid.cast("string").alias("recordId"),
        F.when(eid % 9 == 0, "CATALOG").when(eid % 9 == 1, F.lit(None)).otherwise("FORM").alias("recordType"),
        F.when(eid % 4 == 0, "New Record").otherwise("Record Complete").alias("recordStatus"),
        F.col("ts").alias("dateCreated"),
        F.timestamp_add("DAY", (eid % 5).cast("int"), F.col("ts")).alias("dateModified"))
