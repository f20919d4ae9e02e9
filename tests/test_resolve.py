"""Visit resolution edge cases on hand-made frames (one per outcome)."""

from ledgerlight.operators import resolve as RV

EXT = ("study_key string, subj_id string, interval_name string, visitid_instanceid string, visit_date string, "
       "is_deleted string, subjectKey string, visit_type string, ieyn string, source string, site_name string")
LONG_SITE = "Northern Valley Clinical Research Center - Building 7 West"  # 58 characters


def _refs(spark):
    study = spark.createDataFrame([("S1", "Study one", "ST1"), ("S2", "Study two", "ST2(Prod)")],
                                  "id string, name string, external_id string")
    site = spark.createDataFrame([("SI1", "S1", LONG_SITE[:50], "C1"), ("SI2", "S2", "Site B", "C2"),
                                  ("SI3", "S1", "No Country Site", None)],
                                 "id string, study string, external_id string, study_country string")
    subject = spark.createDataFrame([("SU1", "ST1-K1"), ("SU2", "ST2(Prod)-K2"), ("SU3", "ST1-K3")],
                                    "id string, external_id string")
    vdef = spark.createDataFrame([("VD1", "S1", "V1", "ST1-V1-SF"), ("VD2", "S2", "V1", "ST2(Prod)-V1-SF"),
                                  ("VD9", "S1", None, "ST1-SCR-SF")],
                                 "id string, study string, name string, external_id string")
    visit = spark.createDataFrame([("VIS7", "ST1-K1-7")], "id string, external_id string")
    return study, site, subject, vdef, visit


def _resolve(spark, rows, **kw):
    v = spark.createDataFrame(rows, EXT)
    out = RV.resolve_visits(v, *_refs(spark), **kw)
    return {r.visitid_instanceid: r for r in out.collect()}


def test_outcomes(spark):
    rows = [
        # found directly, existing visit -> update, submitted (micro-second date)
        ("ST1", "1", "V1", "7", "2024-01-05 10:00:00.123456", "0", "K1", None, None, "other", LONG_SITE),
        # fallback to '(Prod)' for the medidata source; deleted flag 'True'; insert
        ("ST2", "2", "V1", "8", "2024-01-05 10:00:00", "True", "K2", "", "yes", "Medidata ", "Site B"),
        # same study without the fallback source -> study not found
        ("ST2", "2", "V1", "9", None, "0", "K2", None, None, "other", "Site B"),
        # missing site name
        ("ST1", "1", "V1", "10", None, "0", "K1", None, None, "other", None),
        # site exists but has no country
        ("ST1", "3", "V1", "11", None, "1", "K3", None, None, "other", "No Country Site"),
        # subject missing
        ("ST1", "4", "V1", "12", None, "0", "K4", None, None, "other", LONG_SITE),
        # screen-fail visit resolves its definition by external id; in progress
        ("ST1", "1", "SCR", "13", None, "0", "K1", None, " No ", "other", LONG_SITE),
        # unscheduled visit without a definition by name
        ("ST1", "1", "UNK", "14", None, "0", "K1", "USV", None, "other", LONG_SITE),
        # unparsable date
        ("ST1", "1", "V1", "15", "05/01/2024", "0", "K1", None, None, "other", LONG_SITE),
    ]
    r = _resolve(spark, rows)
    a = r["7"]
    assert (a.study_id, a.site_id, a.subject_id, a.visitdef_id, a.target_visit_id) == ("S1", "SI1", "SU1", "VD1", "VIS7")
    assert (a.method, a.responsestatus, a.visit_status, a.visit_date_iso) == ("update", "SUCCESSFUL", "submitted__v",
                                                                              "2024-01-05")
    assert a.external_id == "ST1-K1-7" and a.category == RV.STANDARD
    b = r["8"]
    assert (b.study_id, b.study_ext, b.method, b.visit_status) == ("S2", "ST2(Prod)", "insert", "deleted_in_cdms__v")
    assert b.external_id == "ST2(Prod)-K2-8" and b.error_message is None
    assert r["9"].error_message == "Study not found for externalId 'ST2'"
    assert r["9"].method == "insert" and r["9"].responsestatus == "FAILURE"
    assert r["10"].error_message == "Site name missing for study 'ST1' and subject 'K1'"
    assert r["11"].error_message == "Missing country for site 'No Country Site'"
    assert r["12"].error_message == "Subject 'K4' not found for study 'ST1'"
    c = r["13"]
    assert (c.category, c.visitdef_id, c.visit_status, c.error_message) == (RV.SCREENFAIL, "VD9", "in_progress__v", None)
    assert r["14"].error_message == "Visit Definition not found for interval='UNK', VisitType='Unscheduled visit'"
    assert r["15"].error_message == "time data '05/01/2024' does not match format '%Y-%m-%d %H:%M:%S'"


def test_screenfail_trigger_is_a_parameter(spark):
    row = [("ST1", "1", "V1", "20", None, "0", "K1", None, "yes", "other", LONG_SITE)]
    assert _resolve(spark, row)["20"].category == RV.STANDARD
    assert _resolve(spark, row, screenfail_value="yes")["20"].category == RV.SCREENFAIL


def test_payloads_and_log(spark):
    from pyspark.sql import functions as F
    v = spark.createDataFrame([
        ("ST1", "1", "V1", "7", "2024-01-05 10:00:00", "0", "K1", None, None, "other", LONG_SITE),
        ("ST2", "2", "V1", "8", None, "0", "K2", None, None, "medidata", "Site B")], EXT)
    res = RV.resolve_visits(v, *_refs(spark))
    ins = RV.insert_payload(res).collect()
    upd = RV.update_payload(res).collect()
    assert len(ins) == 1 and len(ins[0]) == 9 and ins[0].reporting_status__c == "active__c"
    assert len(upd) == 1 and upd[0].id == "VIS7" and len(upd[0]) == 4
    log = RV.outcome_rows(res, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")).collect()
    assert {(r.visit_instance_id, r.method, r.responsestatus) for r in log} == {("7", "update", "SUCCESSFUL"),
                                                                                 ("8", "insert", "SUCCESSFUL")}


def test_retry_of_a_visit_without_source(spark):
    import datetime as dt

    from ledgerlight.plans import clinical as PC
    from ledgerlight.sources import clinical as C
    from ledgerlight.sources.tables import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    log = spark.createDataFrame([("S-0001", "click", None, "FAILURE", "insert", "x", dt.datetime(2024, 1, 1),
                                  "SubjectVisit", "no-such-visit"),
                                 ("S-0001", "click", None, "SUCCESSFUL", "insert", None, dt.datetime(2024, 1, 1),
                                  "SubjectVisit", "0")], C.LOG_SCHEMA)
    run = C.ntz_literal(dt.datetime(2024, 2, 1))
    missing = PC.retry_without_source(t, log, run).collect()
    assert [(r.visit_instance_id, r.error_message, r.method) for r in missing] == [
        ("no-such-visit", PC.MSG_NO_SOURCE, "insert")]
    assert PC.retry_source(t, log).count() == 0  # the successful row is not retried


def test_run_sync_job_writes_versions(spark):
    import datetime as dt

    from ledgerlight.plans import clinical as PC
    out = PC.run_sync(spark, "/root/testdata/sf0.001")
    assert out["successes"] > 0
    log = spark.read.parquet(out["log"])
    assert log.count() == PC.sync_visits_log(spark, "/root/testdata/sf0.001").count()
    ins = spark.read.parquet(out["payloads"] + "/method=insert")
    upd = spark.read.parquet(out["payloads"] + "/method=update")
    assert ins.count() + upd.count() == out["successes"]
    assert spark.read.parquet(out["last_sync"]).first().last_sync == dt.datetime(2024, 2, 1)
