"""Ingest queries: landed JSON pages and an all-text sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import bronze
from ..sources import clinical as C
from ..sources import landing as L
from ..sources.tables import Tables
from .registry import ORACLE, query

PAGE_SIZE = 500
VISIT_FIELDS = ["visitId", "intervalName", "subjectId", "subjectKey", "visitDate", "deleted", "dateCreated",
                "dateModified"]
ISO_MICRO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def landed_visit_rows(t: Tables) -> DataFrame:
    v = C.visits(t)
    return v.select("studyKey", F.col("visitid_instanceid").alias("visitId"), "intervalName", "subjectId",
                    "subjectKey", "visitDate", "deleted",
                    F.date_format("dateCreated", ISO_MICRO).alias("dateCreated"),
                    F.date_format("dateModified", ISO_MICRO).alias("dateModified"),
                    F.floor(F.col("visitid_instanceid").cast("long") / PAGE_SIZE).alias("page"))


@query("envelope_explode")
def envelope_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the visits as paged JSON envelopes (one folder per study), then
    ingest every page of every study in one read: explode the data array,
    take the study key from the path, stamp the page timestamp, type the
    date columns."""
    t = Tables(spark, sf_dir)
    out = scratch_path(spark, "landed-visits")
    L.land_pages(landed_visit_rows(t), "studyKey", "page", "dateModified", VISIT_FIELDS, out)
    rows = L.read_pages(spark, out, VISIT_FIELDS)
    typed = L.cast_to_schema(rows, {"dateCreated": "timestamp_ntz", "dateModified": "timestamp_ntz"})
    return typed.drop("total_pages")


ORACLE["envelope_explode"] = """WITH v AS (
  SELECT event_type AS studyKey, CAST(event_id AS VARCHAR) AS visitId, 'Visit ' || CAST(event_id % 6 + 1 AS VARCHAR) AS intervalName,
         CAST(user_id AS VARCHAR) AS subjectId, 'S-' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS subjectKey,
         CASE WHEN event_id % 3 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
              WHEN event_id % 3 = 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS visitDate,
         CASE WHEN event_id % 20 = 0 THEN '1' WHEN event_id % 20 = 10 THEN 'true' WHEN event_id % 20 = 5 THEN 'True'
              WHEN event_id % 20 = 15 THEN NULL ELSE '0' END AS deleted,
         ts AS dateCreated, ts + to_days(CAST(event_id % 5 AS INTEGER)) AS dateModified,
         event_id // """ + str(PAGE_SIZE) + """ AS page
  FROM events)
SELECT studyKey, visitId, intervalName, subjectId, subjectKey, visitDate, deleted, dateCreated, dateModified,
       max(strftime(dateModified, '%Y-%m-%dT%H:%M:%S.%f')) OVER (PARTITION BY studyKey, page) AS "timestamp"
FROM v"""


@query("sheet_load")
def sheet_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the customer table as a sheet (a missing balance written as
    'nan'), load it back with every column as text and count per segment."""
    t = Tables(spark, sf_dir)
    c = t.customer.select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("name"),
                          F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).otherwise("nan")
                          .alias("balance"), F.col("c_mktsegment").alias("segment"))
    out = scratch_path(spark, "sheet")
    c.write.option("header", True).csv(out)
    s = L.read_sheet_as_strings(spark, out)
    return s.groupBy("segment").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.count(F.when(F.col("balance").isNull(), F.lit(1))).alias("n_missing_balance"))


ORACLE["sheet_load"] = """SELECT c_mktsegment AS segment, count(*) AS n_rows,
       count(*) FILTER (WHERE c_acctbal < 0 OR c_acctbal IS NULL) AS n_missing_balance
FROM customer GROUP BY c_mktsegment"""


@query("bronze_incremental_load")
def bronze_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze ingest end to end: landed pages of every study read in
    one plan, typed, and cut to each table's extraction window from the
    watermark config (half-open (lo, hi] on created or modified)."""
    from ..operators import state as ST
    from ..operators.joins import join_dim
    from .clinical import WINDOW_END
    t = Tables(spark, sf_dir)
    out = scratch_path(spark, "landed-visits")
    L.land_pages(landed_visit_rows(t), "studyKey", "page", "dateModified", VISIT_FIELDS, out)
    rows = L.cast_to_schema(L.read_pages(spark, out, VISIT_FIELDS),
                            {"dateCreated": "timestamp_ntz", "dateModified": "timestamp_ntz"})
    win = ST.extraction_windows(C.table_watermarks(t), C.ntz_literal(WINDOW_END)).select("table_name", "min_ts", "max_ts")
    j = join_dim(rows.withColumn("table_name", F.concat(F.lit("i_"), F.col("studyKey"))), win, "table_name", "inner")
    j = j.where(ST.in_change_window(F.col("dateCreated"), F.col("dateModified"), F.col("min_ts"), F.col("max_ts")))
    return j.select("table_name", "studyKey", "visitId", "subjectKey", "visitDate", "dateCreated", "dateModified",
                    "timestamp")


def _bronze_sql() -> str:
    from .clinical import WINDOW_END
    base = ORACLE["envelope_explode"]
    return f"""WITH env AS ({base}),
cfg AS (
  SELECT 'i_' || event_type AS table_name,
         CASE WHEN event_type = 'signup' THEN 'not a date' ELSE strftime(min(ts), '%Y-%m-%dT%H:%M:%S') END AS latest
  FROM events GROUP BY event_type),
win AS (SELECT table_name, TRY_CAST(latest AS TIMESTAMP) AS min_ts, TIMESTAMP '{WINDOW_END}' AS max_ts
        FROM cfg WHERE TRY_CAST(latest AS TIMESTAMP) IS NOT NULL)
SELECT w.table_name, e.studyKey, e.visitId, e.subjectKey, e.visitDate, e.dateCreated, e.dateModified, e."timestamp"
FROM env e JOIN win w ON w.table_name = 'i_' || e.studyKey
WHERE (e.dateCreated > w.min_ts AND e.dateCreated <= w.max_ts) OR (e.dateModified > w.min_ts AND e.dateModified <= w.max_ts)"""


ORACLE["bronze_incremental_load"] = _bronze_sql()


def run_bronze(spark: SparkSession, sf_dir: str) -> dict:
    """The bronze ingest as a job: every landed page of every study in one
    read, cut to the per-table windows, written once as a new bronze version
    partitioned by study (no per-page or per-study writes); each loaded
    table's watermark advanced to the window end (SQL timestamp text); one
    execution-log row per table.  Returns the written paths."""
    from ..functions.dates import SQL_TS
    from ..operators import state as ST
    from ..sources import sinks as K
    from .clinical import WINDOW_END
    rows = bronze_incremental_load(spark, sf_dir).checkpoint(eager=True)   # used by three writes
    bronze = K.write_version(rows, spark, "bronze-visits", partition_by=("studyKey",))
    t = Tables(spark, sf_dir)
    cfg = C.table_watermarks(t)
    loaded = rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"),
                                            F.min("dateCreated").alias("start_time"),
                                            F.max("dateModified").alias("end_time"))
    end_text = C.ntz_literal(WINDOW_END)
    nxt = (cfg.join(loaded.select(F.col("table_name").alias("Table"), "row_count"), "Table", "left")
              .withColumn("Latest_Date", F.when(F.col("row_count") > 0, F.date_format(end_text, SQL_TS))
                          .otherwise(F.col("Latest_Date"))).drop("row_count"))
    config = K.write_version(nxt, spark, "config-table")
    log = K.write_version(ST.run_log(loaded.withColumnRenamed("table_name", "table"), "Bronze", "visits"),
                          spark, "execution-log")
    return {"bronze": bronze, "config": config, "log": log}


# ------------------------------------------------- the other bronze tables

def land_bronze(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A bronze table landed as pages; returns the folder."""
    out = scratch_path(spark, f"landed-{name}")
    return L.land_pages(bronze.landed_rows(Tables(spark, sf_dir), name), "studyKey", "page", "dateModified", bronze.BRONZE[name].fields, out)


def load_bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Every page of every study of a bronze table in one read, typed."""
    fields = bronze.BRONZE[name].fields
    rows = L.read_pages(spark, land_bronze(spark, sf_dir, name), fields)
    return L.cast_to_schema(rows, {c: "timestamp_ntz" for c in bronze.DATES}).drop("total_pages")


def _bronze_table_sql(name: str) -> str:
    table = bronze.BRONZE[name]
    return (f"SELECT studyKey, {', '.join(table.fields)}, "
            f"max(strftime(dateModified, '%Y-%m-%dT%H:%M:%S.%f')) OVER (PARTITION BY studyKey, page) AS \"timestamp\" "
            f"FROM ({table.sql.format(events='events')}) x")


def _register(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return load_bronze(spark, sf_dir, name)
    run.__doc__ = f"The bronze table {name}: landed pages of every study, read and typed."
    query(f"bronze_{name}", _bronze_table_sql(name))(run)


for _name in bronze.BRONZE:
    _register(_name)


@query("bronze_page_status", f"""SELECT event_type AS studyKey, CAST(count(DISTINCT event_id // {PAGE_SIZE}) AS INTEGER) AS expected_pages,
       count(DISTINCT event_id // {PAGE_SIZE}) AS pages_found, TRUE AS complete FROM events GROUP BY event_type""")
def bronze_page_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per study: landed pages against the count that the pages announce."""
    out = scratch_path(spark, "landed-visits")
    L.land_pages(landed_visit_rows(Tables(spark, sf_dir)), "studyKey", "page", "dateModified", VISIT_FIELDS, out)
    return L.page_status(L.read_envelopes(spark, out, VISIT_FIELDS))


@query("bronze_visits_full", f"""WITH env AS ({ORACLE["envelope_explode"]})
SELECT 'i_' || studyKey AS table_name, * FROM env""")
def bronze_visits_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visits reloaded in full: every landed row, whatever the watermark."""
    return envelope_explode(spark, sf_dir).withColumn("table_name", F.concat(F.lit("i_"), F.col("studyKey")))


# --------------------------------------------------- damaged and absent pages

FAULT_PAGE = 50
FAULT_FIELDS = ["event_id", "user_id", "props"]
#: What happens to a page on its way (0 of 11: never landed, 2: cut short, 5: not JSON).
_FATE_SQL = "(p * 7 + length({study})) % 11"


def landed_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as numbered pages of 50, some of them absent or damaged, read back."""
    t = Tables(spark, sf_dir)
    rows = t.events.select("event_type", F.floor(F.col("event_id") / FAULT_PAGE).alias("p"), *FAULT_FIELDS)
    fate = F.expr(_FATE_SQL.format(study="event_type"))
    out = scratch_path(spark, "landed-faults")
    L.land_numbered_pages(rows, "event_type", "p", FAULT_FIELDS, out, absent=fate.isin(0, 1), cut_short=fate == 2, garbled=fate == 5)
    return L.read_checked(spark, out, FAULT_FIELDS)


_FAULT_CTES = f"""WITH pg AS (SELECT DISTINCT event_type AS study, event_id // {FAULT_PAGE} AS p FROM events),
tot AS (SELECT study, max(p) + 1 AS total FROM pg GROUP BY study),
f AS (SELECT study, p, {_FATE_SQL.format(study='study')} AS fate FROM pg),
told AS (SELECT study, total FROM tot WHERE study IN (SELECT study FROM f WHERE fate NOT IN (0, 1, 5)))"""


@query("page_faults", _FAULT_CTES + """,
every AS (SELECT study, unnest(range(total)) AS p FROM told),
miss AS (SELECT study, p FROM every WHERE (study, p) NOT IN (SELECT (study, p) FROM f WHERE fate NOT IN (0, 1, 5))),
bad AS (SELECT study, 'missing' AS kind, p FROM miss UNION ALL SELECT study, 'damaged', p FROM f WHERE fate = 2),
isle AS (SELECT *, p - row_number() OVER (PARTITION BY study, kind ORDER BY p) AS g FROM bad)
SELECT study AS "studyKey", kind, CAST(min(p) AS INTEGER) AS first_page, CAST(max(p) AS INTEGER) AS last_page, count(*) AS n_pages FROM isle GROUP BY study, kind, g
UNION ALL SELECT study, 'damaged', NULL, NULL, count(*) FROM f WHERE fate = 5 GROUP BY study""")
def page_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of missing and of damaged pages per study, over landed pages of which
    some are absent, some cut short and some no JSON."""
    return L.page_faults(landed_with_faults(spark, sf_dir))


@query("whole_page_rows", _FAULT_CTES + f"""
SELECT e.event_type AS "studyKey", CAST(f.p AS INTEGER) AS page, count(*) AS n_rows, count(DISTINCT e.event_id) AS n_events,
       min(e.event_id) AS first_event, max(CAST(e.user_id AS BIGINT)) AS last_user
FROM events e JOIN f ON f.study = e.event_type AND f.p = e.event_id // {FAULT_PAGE} WHERE fate NOT IN (0, 1, 2, 5) GROUP BY ALL""")
def whole_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the pages that landed whole, summarised by page."""
    rows = L.whole_rows(landed_with_faults(spark, sf_dir))
    return rows.groupBy("studyKey", "page").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_events"),
        F.min(F.col("event_id").cast("long")).alias("first_event"), F.max(F.col("user_id").cast("long")).alias("last_user"))


# --------------------------------------------------------- evolving versions

@query("evolved_events", """
SELECT event_id, ts, event_type, user_id, CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE value END AS value,
       CAST(CASE WHEN event_type NOT IN ('click') THEN length(event_type) END AS BIGINT) AS type_chars,
       CASE WHEN event_type IN ('signup', 'error') THEN props END AS props
FROM events""")
def evolved_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events appended in three commits of differing columns (an added one, a
    missing one, one whose type widens) and read as the table's current version;
    the last commit is replayed, which changes nothing."""
    from ..sources import versions as V
    events = Tables(spark, sf_dir).events
    kind = F.coalesce(F.col("event_type"), F.lit(""))
    first = events.where(kind == "click").select("event_id", "ts", "event_type", "user_id", "value")
    second = events.where(~kind.isin("click", "signup", "error")).withColumn("type_chars", F.length("event_type").cast("int")).drop("props")
    third = events.where(kind.isin("signup", "error")).withColumn("type_chars", F.length("event_type").cast("long")).drop("value")
    root = scratch_path(spark, "events-versions")
    for batch, rows in (("clicks", first), ("others", second), ("faults", third), ("faults", third)):
        V.append(spark, root, rows, batch)
    return V.read(spark, root)
