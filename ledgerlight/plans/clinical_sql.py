"""SQL twins of ``sources.clinical`` for the DuckDB oracles."""

from __future__ import annotations

from ..sources import clinical as C


# The stored last-sync time (midnight 15 days after the first visit).
WM = "(SELECT CAST(CAST(min(ts) AS DATE) + 15 AS TIMESTAMP) FROM events)"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def study_ext(col: str) -> str:
    return f"(CASE WHEN {col} IN {_in(C.PROD_SUFFIX_STUDIES)} THEN {col} || '(Prod)' ELSE {col} END)"


VISITS = f"""visits AS (
  SELECT event_type AS studyKey, CAST(user_id AS VARCHAR) AS subjectId,
         'Visit ' || CAST(event_id % 6 + 1 AS VARCHAR) AS intervalName,
         CAST(event_id AS VARCHAR) AS visitid_instanceid,
         CASE WHEN event_id % 3 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
              WHEN event_id % 3 = 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS visitDate,
         CASE WHEN event_id % 20 = 0 THEN '1' WHEN event_id % 20 = 10 THEN 'true' WHEN event_id % 20 = 5 THEN 'True'
              WHEN event_id % 20 = 15 THEN NULL ELSE '0' END AS deleted,
         'S-' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS subjectKey,
         CASE WHEN event_id % 7 = 0 THEN 'usv' WHEN event_id % 7 = 1 THEN '' END AS visitType,
         CASE WHEN event_id % 11 = 0 THEN 'No' WHEN event_id % 11 = 1 THEN 'yes' END AS ieyn,
         CASE WHEN event_type IN {_in(C.MEDIDATA_STUDIES)} THEN 'medidata' ELSE 'other' END AS source,
         ts AS dateCreated, ts + to_days(CAST(event_id % 5 AS INTEGER)) AS dateModified
  FROM events)"""

SUBJECT_DIM = """sdim AS (
  SELECT p.event_type AS studyKey, CAST(p.user_id AS VARCHAR) AS subjectId,
         CASE WHEN c.c_acctbal >= 0 THEN concat_ws(' ', c.c_name, 'clinical research site', c.c_mktsegment, 'nation', n.n_name) END AS siteName
  FROM (SELECT DISTINCT event_type, user_id FROM events) p
  LEFT JOIN customer c ON p.user_id = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

STUDY = f"""study AS (
  SELECT 'STU-' || upper(st) AS id, {study_ext('st')} AS external_id
  FROM (SELECT DISTINCT event_type AS st FROM events) WHERE st NOT IN {_in(C.ABSENT_STUDIES)})"""

SITE = f"""site AS (
  SELECT 'SITE-' || d.studyKey || '-' || d.subjectId AS id, 'STU-' || upper(d.studyKey) AS study,
         substring(d.siteName, 1, 50) AS external_id,
         CASE WHEN c.c_nationkey <> {C.NO_COUNTRY_NATION} THEN 'CTRY-' || n.n_name END AS study_country
  FROM sdim d LEFT JOIN customer c ON d.subjectId = CAST(c.c_custkey AS VARCHAR)
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE d.siteName IS NOT NULL AND c.c_nationkey IS DISTINCT FROM {C.UNSET_SITE_NATION})"""

SUBJECT = f"""subj AS (
  SELECT 'SUB-' || event_type || '-' || CAST(user_id AS VARCHAR) AS id,
         {study_ext('event_type')} || '-' || 'S-' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS external_id
  FROM (SELECT DISTINCT event_type, user_id FROM events WHERE ts < {WM})
  WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = {C.UNREGISTERED_NATION}))"""

VISIT_DEF = f"""vdef AS (
  SELECT 'VD-' || studyKey || '-' || replace(intervalName, ' ', '') AS id, 'STU-' || upper(studyKey) AS study,
         CASE WHEN intervalName <> '{C.UNDEFINED_INTERVAL}' THEN intervalName END AS name,
         {study_ext('studyKey')} || '-' || intervalName || '-SF' AS external_id
  FROM (SELECT DISTINCT studyKey, intervalName FROM visits))"""

VISIT = f"""vis AS (
  SELECT 'VIS-' || visitid_instanceid AS id,
         concat_ws('-', {study_ext('studyKey')}, subjectKey, visitid_instanceid) AS external_id
  FROM visits WHERE dateCreated < {WM})"""

REFS = [VISITS, SUBJECT_DIM, STUDY, SITE, SUBJECT, VISIT_DEF, VISIT]


def s(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'None')"


ISO_DATE = ("strftime(CAST(coalesce(try_strptime(visit_date, '%Y-%m-%d %H:%M:%S.%f'), "
            "try_strptime(visit_date, '%Y-%m-%d %H:%M:%S')) AS DATE), '%Y-%m-%d')")

# First row per lookup key of each reference table.
REF_LOOKUPS = [
    "st AS (SELECT external_id, min(id) AS id FROM study GROUP BY external_id)",
    "si AS (SELECT study, external_id, min(id) AS site_id, arg_min(study_country, id) AS country_id "
    "FROM site GROUP BY study, external_id)",
    "su AS (SELECT external_id, min(id) AS subject_id FROM subj GROUP BY external_id)",
    "vdn AS (SELECT study, name, min(id) AS vd FROM vdef WHERE name IS NOT NULL GROUP BY study, name)",
    "vde AS (SELECT external_id, min(id) AS vd FROM vdef GROUP BY external_id)",
    "vi AS (SELECT external_id, min(id) AS target_visit_id FROM vis GROUP BY external_id)",
]


def batch_v1(src_where: str) -> list[str]:
    """The changed-visit extract joined to the subject dimension (``v1``)."""
    v0 = ("v0 AS (SELECT CAST(studyKey AS VARCHAR) AS study_key, CAST(subjectId AS VARCHAR) AS subj_id, "
          "CAST(intervalName AS VARCHAR) AS interval_name, CAST(visitid_instanceid AS VARCHAR) AS visitid_instanceid, "
          "CAST(visitDate AS VARCHAR) AS visit_date, CAST(deleted AS VARCHAR) AS is_deleted, "
          "CAST(subjectKey AS VARCHAR) AS subjectKey, CAST(visitType AS VARCHAR) AS visit_type, "
          f"CAST(ieyn AS VARCHAR) AS ieyn, CAST(source AS VARCHAR) AS source FROM visits WHERE {src_where})")
    v1 = ("v1 AS (SELECT v0.*, d.siteName AS site_name FROM v0 "
          "LEFT JOIN sdim d ON v0.study_key = d.studyKey AND v0.subj_id = d.subjectId)")
    return [v0, v1]


def _q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def _msg(*parts) -> str:
    """Concatenate literal text and rendered columns: parts alternate
    between plain strings (literal) and ('col',) tuples (column)."""
    out = []
    for p in parts:
        out.append(s(p[0]) if isinstance(p, tuple) else _q(p))
    return " || ".join(out)


def _errors() -> str:
    checks = [
        ("visit_date IS NOT NULL AND visit_date <> '' AND visit_date_iso IS NULL",
         _msg("time data '", ("visit_date",), "' does not match format '%Y-%m-%d %H:%M:%S'")),
        ("study_key IS NULL", _q("Missing required field 'study_key'")),
        ("subjectKey IS NULL", _q("Missing required field 'subjectKey'")),
        ("interval_name IS NULL", _q("Missing required field 'interval_name'")),
        ("visitid_instanceid IS NULL", _q("Missing required field 'visitid_instanceid'")),
        ("coalesce(site_name, '') = ''",
         _msg("Site name missing for study '", ("study_key",), "' and subject '", ("subjectKey",), "'")),
        ("study_id IS NULL", _msg("Study not found for externalId '", ("study_key",), "'")),
        ("site_id IS NULL", _msg("Site '", ("site_name",), "' not found for study '", ("study_ext",), "'")),
        ("coalesce(country_id, '') = ''", _msg("Missing country for site '", ("site_name",), "'")),
        ("subject_id IS NULL", _msg("Subject '", ("subjectKey",), "' not found for study '", ("study_ext",), "'")),
        ("visitdef_id IS NULL", _msg("Visit Definition not found for interval='", ("interval_name",),
                                     "', VisitType='", ("category",), "'")),
    ]
    return "coalesce(" + ", ".join(f"CASE WHEN {c} THEN {m} END" for c, m in checks) + ")"


def resolve_chain(p: str, src: str) -> list[str]:
    """Resolution CTEs ``{p}w1`` .. ``{p}res`` over the CTE ``src`` (the
    extract columns plus site_name)."""
    w1 = (f"{p}w1 AS (SELECT trim(study_key) AS study_key, subj_id, trim(interval_name) AS interval_name, "
          "trim(visitid_instanceid) AS visitid_instanceid, visit_date, is_deleted, trim(subjectKey) AS subjectKey, "
          "visit_type, ieyn, source, site_name, lower(trim(coalesce(source, ''))) AS src, "
          f"CASE WHEN coalesce(visit_date, '') <> '' THEN {ISO_DATE} END AS visit_date_iso FROM {src})")
    v2 = (f"{p}v2 AS (SELECT w.*, coalesce(s1.id, s2.id) AS study_id, "
          "CASE WHEN s1.id IS NOT NULL THEN w.study_key ELSE s2.external_id END AS study_ext "
          f"FROM {p}w1 w LEFT JOIN st s1 ON s1.external_id = w.study_key "
          "LEFT JOIN st s2 ON s2.external_id = CASE WHEN w.src = 'medidata' THEN w.study_key || '(Prod)' END)")
    v3 = (f"{p}v3 AS (SELECT x.*, study_ext || '-' || subjectKey || '-' || visitid_instanceid AS external_id, "
          "study_ext || '-' || interval_name || '-SF' AS visit_def_external_id, "
          "study_ext || '-' || subjectKey AS subject_external_id, "
          "CASE WHEN lower(trim(coalesce(visit_type, ''))) = 'usv' THEN 'Unscheduled visit' "
          "WHEN (CASE WHEN coalesce(ieyn, '') <> '' THEN lower(trim(ieyn)) END) = 'no' THEN 'Screenfail visit' "
          f"ELSE 'Standard visit' END AS category FROM {p}v2 x)")
    v4 = (f"{p}v4 AS (SELECT v3.*, si.site_id, si.country_id, su.subject_id, "
          "CASE WHEN v3.category = 'Screenfail visit' THEN vde.vd ELSE vdn.vd END AS visitdef_id, vi.target_visit_id, "
          "CASE WHEN v3.is_deleted IN ('1', 'true', 'True') THEN 'deleted_in_cdms__v' "
          "WHEN v3.visit_date_iso IS NOT NULL THEN 'submitted__v' ELSE 'in_progress__v' END AS visit_status "
          f"FROM {p}v3 v3 "
          "LEFT JOIN si ON si.study = v3.study_id AND si.external_id = substring(v3.site_name, 1, 50) "
          "LEFT JOIN su ON su.external_id = v3.subject_external_id "
          "LEFT JOIN vdn ON vdn.study = v3.study_id AND vdn.name = v3.interval_name "
          "LEFT JOIN vde ON vde.external_id = v3.visit_def_external_id "
          "LEFT JOIN vi ON vi.external_id = v3.external_id)")
    v5 = f"{p}v5 AS (SELECT v4.*, {_errors()} AS error_message FROM {p}v4 v4)"
    res = (f"{p}res AS (SELECT v5.*, CASE WHEN error_message IS NULL THEN 'SUCCESSFUL' ELSE 'FAILURE' END "
           "AS responsestatus, CASE WHEN error_message IS NULL AND target_visit_id IS NOT NULL THEN 'update' "
           f"ELSE 'insert' END AS method FROM {p}v5 v5)")
    return [w1, v2, v3, v4, v5, res]


def resolve_ctes(src_where: str = "TRUE") -> list[str]:
    """CTEs ending in ``res``: the resolved batch of visits matching
    ``src_where`` (a predicate over ``visits``)."""
    return REFS + REF_LOOKUPS + batch_v1(src_where) + resolve_chain("", "v1")


def with_(ctes) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
