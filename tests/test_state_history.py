"""The sync's two tables over runs that succeed, fail, repeat and end half way."""

import datetime as dt

from ledgerlight.plans import clinical as P
from ledgerlight.session import scratch_path
from ledgerlight.sources import clinical as C
from ledgerlight.sources import versions as V

ONE, TWO, THREE = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)


def mark(spark, root):
    return V.read(spark, root).first()["last_sync"]


def test_watermark_follows_successes(spark):
    marks, logs = scratch_path(spark, "marks"), scratch_path(spark, "logs")
    good = spark.createDataFrame([("a", "SUCCESSFUL"), ("b", "FAILURE")], "visit_instance_id string, responsestatus string")
    bad = good.where("responsestatus = 'FAILURE'")
    P.state_history(spark, marks, logs, bad, ONE)                     # first use: created; nothing went through
    assert mark(spark, marks) == C.DEFAULT_WATERMARK and V.read(spark, logs).count() == 1
    P.state_history(spark, marks, logs, good.limit(0), TWO)           # an empty run
    assert mark(spark, marks) == C.DEFAULT_WATERMARK and V.read(spark, logs).count() == 1
    P.state_history(spark, marks, logs, good, THREE)
    assert mark(spark, marks) == THREE and V.read(spark, logs).count() == 3
    before = V.versions(spark, marks), V.versions(spark, logs)
    P.state_history(spark, marks, logs, good, THREE)                  # repeated
    assert (V.versions(spark, marks), V.versions(spark, logs)) == before and V.read(spark, logs).count() == 3


def test_run_that_ended_between_log_and_watermark(spark):
    marks, logs = scratch_path(spark, "marks"), scratch_path(spark, "logs")
    good = spark.createDataFrame([("a", "SUCCESSFUL")], "visit_instance_id string, responsestatus string")
    V.append(spark, logs, good, f"run {ONE}")                         # the log alone was published
    P.state_history(spark, marks, logs, good, ONE)
    assert mark(spark, marks) == ONE and V.read(spark, logs).count() == 1
