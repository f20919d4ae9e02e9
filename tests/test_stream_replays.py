"""The visit stream with replayed, late, changed and failing events."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlight.sources import clinical as C
from ledgerlight.streaming.visit_sync import read_sync_log, start_visit_sync

SF = "/root/testdata/sf0.001"
RUN, CUTOFF = dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 16)
EMPTY_LOG = C.LOG_SCHEMA


def land(df, folder, name):
    df.coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, folder, refs, out, **more):
    q = start_visit_sync(spark, f"{folder}/*", refs, out + "/out", out + "/ckpt", RUN, CUTOFF, file_glob="*.parquet", max_files_per_trigger=1, **more)
    q.awaitTermination(300)
    assert q.exception() is None


def latest(spark, folder):
    """The table of the last micro-batch (the watermark takes one of its own, without events)."""
    import os
    return spark.read.parquet(f"{folder}/epoch={max(int(n.split('=')[1]) for n in os.listdir(folder) if n.startswith('epoch='))}")


def statuses(rows):
    """Visit to its states; a visit that went through once has no failure left."""
    out = {}
    for r in rows:
        out.setdefault((r.subjectKey, r.study_key, r.visit_instance_id), set()).add(r.responsestatus)
    return out


def refs_without(spark, tmp, share):
    """Reference tables that lack some of the customers (and so of the sites)."""
    import shutil
    for name in ("events", "nation", "region"):
        shutil.copy(f"{SF}/{name}.parquet", f"{tmp}/{name}.parquet")
    spark.read.parquet(f"{SF}/customer.parquet").where(F.col("c_custkey") % share != 0).write.parquet(f"{tmp}/customer.parquet")
    return str(tmp)


def test_replayed_and_late_events_are_logged_once(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    folder, out = str(tmp_path / "landed"), str(tmp_path)
    early = F.col("ts") < dt.datetime(2024, 1, 10)
    land(events.where(~early), folder, "a")
    land(events.where(early).unionByName(events.where(~early).limit(50)), folder, "b")      # late ones, and replays
    land(events.unionByName(events.limit(20)), folder, "c")
    run(spark, folder, SF, out, lateness="400 days")
    log = read_sync_log(spark, out + "/out")
    assert log.count() == events.count() == log.select("visit_instance_id").distinct().count()
    run(spark, folder, SF, out, lateness="400 days")                                     # nothing new
    assert read_sync_log(spark, out + "/out").count() == events.count()


def test_events_beyond_the_span_are_left_out(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 20)), (2, dt.datetime(2024, 1, 20)), (3, dt.datetime(2023, 1, 1)), (4, dt.datetime(2024, 1, 19))]
    frame = spark.createDataFrame([(i, t, 1, "click", 1.0, None) for i, t in rows], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    folder, out = str(tmp_path / "landed"), str(tmp_path)
    land(frame.where("event_id <= 2"), folder, "a")
    run(spark, folder, SF, out, lateness="2 days")                     # the watermark is 18 January from the next run on
    land(frame.where("event_id > 2"), folder, "b")
    run(spark, folder, SF, out, lateness="2 days")
    assert sorted(r.visit_instance_id for r in read_sync_log(spark, out + "/out").collect()) == ["1", "2", "4"]


def test_failures_are_taken_up_again(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    folder, out = str(tmp_path / "landed"), str(tmp_path)
    (tmp_path / "refs").mkdir()
    poor = refs_without(spark, tmp_path / "refs", 2)
    spark.createDataFrame([], EMPTY_LOG).write.parquet(out + "/log/epoch=-1")
    first = F.col("event_id") % 3 != 0
    land(events.where(first), folder, "a")
    run(spark, folder, poor, out, log_path=out + "/log", lateness="400 days", retry=True)
    before = statuses(latest(spark, out + "/log").collect())
    land(events, folder, "b")                                              # the rest, and replays
    run(spark, folder, SF, out, log_path=out + "/log", lateness="400 days", retry=True)
    after = statuses(latest(spark, out + "/log").collect())
    # A stream over everything with the full references, as the batch sync resolves it.
    whole = str(tmp_path / "whole")
    run(spark, folder, SF, whole, lateness="400 days")
    want = statuses(read_sync_log(spark, whole + "/out").collect())
    assert after == want
    mended = [k for k, s in before.items() if s == {"FAILURE"} and after[k] == {"SUCCESSFUL"}]
    assert mended
    pending = {r.visitid_instanceid for r in latest(spark, out + "/out/pending").collect()}
    assert pending == {k[2] for k, s in want.items() if s == {"FAILURE"}}


def test_each_landing_is_one_micro_batch(spark, tmp_path, monkeypatch):
    import os

    from ledgerlight import session
    from ledgerlight.plans.clinical import streaming_visit_sync_replayed
    (tmp_path / "refs").mkdir()
    refs = refs_without(spark, tmp_path / "refs", 10**9)
    os.remove(f"{refs}/events.parquet")
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(6, "event_id").write.parquet(f"{refs}/events.parquet")
    made = session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda s, name: f"{tmp_path}/{name}" if name in ("landed-events", "visit-sync-out") else made(s, name))
    log = streaming_visit_sync_replayed(spark, refs)
    assert sum(n.endswith(".parquet") for n in os.listdir(f"{tmp_path}/landed-events/first")) > 2
    # The watermark may take a micro-batch of its own, without events.
    assert len([n for n in os.listdir(f"{tmp_path}/visit-sync-out") if n.startswith("epoch=")]) <= 3
    assert log.count() == events.count() == log.select("visit_instance_id").distinct().count()
