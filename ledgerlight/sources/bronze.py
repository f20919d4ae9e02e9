"""The bronze tables besides visits, derived from the events table: their
fields, types and the SQL that derives their rows.

Each statement gives ``studyKey``, ``page`` (the landed page a row is on) and the
table's fields; timestamps are landed as ISO text and read back as
timestamps, everything else stays text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Tables

PAGE_ROWS = 500
ISO_MICRO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DATES = ("dateCreated", "dateModified")


@dataclass(frozen=True)
class BronzeTable:
    fields: tuple[str, ...]       # as delivered; studyKey comes from the path
    sql: str                      # over {events}


_PAIR = "SELECT event_type, user_id, min(ts) AS lo, max(ts) AS hi FROM {events} GROUP BY event_type, user_id"
_KEY = "'S-' || lpad(CAST(user_id AS STRING), 4, '0')"
_PAGE = f"CAST(floor({{}} / {PAGE_ROWS}) AS BIGINT) AS page"

BRONZE = {
    "studies": BronzeTable(
        ("studyId", "studyName", "studyType", "studyDescription", "sponsorKey", *DATES),
        """SELECT event_type AS studyKey, CAST(0 AS BIGINT) AS page, 'STU-' || upper(event_type) AS studyId, 'Study ' || event_type AS studyName,
        'Observational' AS studyType, 'All ' || event_type || ' visits' AS studyDescription, 'SP-' || substring(event_type, 1, 2) AS sponsorKey,
        min(ts) AS dateCreated, max(ts) AS dateModified FROM {events} GROUP BY event_type"""),
    "sites": BronzeTable(
        ("siteId", "siteName", "siteEnrollmentStatus", *DATES),
        f"""SELECT event_type AS studyKey, {_PAGE.format("user_id")}, 'SITE-' || CAST(user_id AS STRING) AS siteId,
        'Site ' || CAST(user_id AS STRING) || ' of ' || event_type AS siteName, CASE WHEN user_id % 3 = 0 THEN 'Closed' ELSE 'Open' END AS siteEnrollmentStatus,
        lo AS dateCreated, hi AS dateModified FROM ({_PAIR}) p"""),
    "subjects": BronzeTable(
        ("subjectId", "subjectOid", "subjectKey", "subjectStatus", "siteId", "siteName", "deleted", "enrollmentStartDate", *DATES, "keywords"),
        f"""SELECT event_type AS studyKey, {_PAGE.format("user_id")}, CAST(user_id AS STRING) AS subjectId, 'OID-' || CAST(user_id AS STRING) AS subjectOid,
        {_KEY} AS subjectKey, CASE WHEN user_id % 7 = 0 THEN 'Withdrawn' ELSE 'Enrolled' END AS subjectStatus, 'SITE-' || CAST(user_id AS STRING) AS siteId,
        'Site ' || CAST(user_id AS STRING) || ' of ' || event_type AS siteName, CASE WHEN user_id % 10 = 0 THEN '1' ELSE '0' END AS deleted,
        CAST(CAST(lo AS DATE) AS STRING) AS enrollmentStartDate, lo AS dateCreated, hi AS dateModified,
        CASE WHEN user_id % 2 = 0 THEN 'even' END AS keywords FROM ({_PAIR}) p"""),
    "queries": BronzeTable(
        ("subjectId", "subjectOid", "annotationType", "annotationId", "type", "description", "recordId", "variable", "subjectKey", *DATES, "queryComments"),
        f"""SELECT event_type AS studyKey, {_PAGE.format("event_id")}, CAST(user_id AS STRING) AS subjectId, 'OID-' || CAST(user_id AS STRING) AS subjectOid,
        'Query' AS annotationType, 'Q-' || CAST(event_id AS STRING) AS annotationId, CASE WHEN event_id % 8 = 0 THEN 'Manual' ELSE 'Auto' END AS type,
        props AS description, CAST(event_id AS STRING) AS recordId, 'value' AS variable, {_KEY} AS subjectKey, ts AS dateCreated, ts AS dateModified,
        CASE WHEN event_id % 12 = 0 THEN 'checked' END AS queryComments FROM {{events}}"""),
    "records": BronzeTable(
        ("siteId", "subjectId", "formId", "formKey", "recordId", "recordType", "recordStatus", "deleted", "dateModified", "dateCreated", "intervalId",
         "subjectKey", "visitId", "parentRecordId"),
        f"""SELECT event_type AS studyKey, {_PAGE.format("event_id")}, 'SITE-' || CAST(user_id AS STRING) AS siteId, CAST(user_id AS STRING) AS subjectId,
        'F' || CAST(event_id % 5 AS STRING) AS formId, 'FK-' || CAST(event_id % 5 AS STRING) AS formKey, CAST(event_id AS STRING) AS recordId,
        CASE WHEN event_id % 9 = 0 THEN 'CATALOG' WHEN event_id % 9 = 1 THEN NULL ELSE 'FORM' END AS recordType,
        CASE WHEN event_id % 4 = 0 THEN 'New Record' ELSE 'Record Complete' END AS recordStatus, '0' AS deleted, ts AS dateModified, ts AS dateCreated,
        'V' || CAST(event_id % 6 + 1 AS STRING) AS intervalId, {_KEY} AS subjectKey, CAST(event_id AS STRING) AS visitId,
        CASE WHEN event_id % 5 = 0 THEN CAST(event_id - 1 AS STRING) END AS parentRecordId FROM {{events}}"""),
    "forms": BronzeTable(
        ("formId", "formKey", "formName", "formType", "revision", "embeddedLog", "enforceOwnership", "userAgreement", "subjectRecordReport",
         "unscheduledVisit", "otherForms", "eproForm", "allowCopy", "disabled", *DATES),
        """SELECT event_type AS studyKey, CAST(0 AS BIGINT) AS page, 'F' || CAST(event_id % 5 AS STRING) AS formId, 'FK-' || CAST(event_id % 5 AS STRING) AS formKey,
        'Form ' || CAST(event_id % 5 AS STRING) AS formName, 'Subject' AS formType, CAST(count(*) AS STRING) AS revision, 'false' AS embeddedLog,
        'false' AS enforceOwnership, 'false' AS userAgreement, 'true' AS subjectRecordReport, 'false' AS unscheduledVisit, 'false' AS otherForms,
        'false' AS eproForm, 'true' AS allowCopy, 'false' AS disabled, min(ts) AS dateCreated, max(ts) AS dateModified
        FROM {events} GROUP BY event_type, event_id % 5"""),
}


def landed_rows(t: Tables, name: str) -> DataFrame:
    """A bronze table's rows as the API delivers them (all text)."""
    df = t.spark.sql(BRONZE[name].sql, events=t.events)
    return df.select("studyKey", "page", *[F.date_format(c, ISO_MICRO).alias(c) if c in DATES else F.col(c)
                                           for c in BRONZE[name].fields])
