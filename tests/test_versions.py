"""Tables as versions: merge by touched files, replays, failed and rival writers, evolving schemas."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlight.operators.state import merge_upsert
from ledgerlight.session import scratch_path
from ledgerlight.sources import versions as V

LOG = "visit int, study string, method string, status string, note string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(spark, root, v=None):
    return {r["path"]: r["bytes"] for r in V.file_list(spark, root, v or V.current(spark, root)).collect()}


@pytest.fixture
def log(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["s", "t", None]), rng.choice(["insert", "update"]), rng.choice(["SUCCESSFUL", "FAILURE"]), "old") for i in range(4000)]
    root = scratch_path(spark, "log")
    V.overwrite(spark, root, spark.createDataFrame(rows, LOG).repartitionByRange(8, "visit"), "first")
    return root


def test_merge_rewrites_touched_files_only(spark, log):
    before = files(spark, log)
    assert len(before) == 8
    target = V.read(spark, log)
    batch = [(v, r.study, r.method, "SUCCESSFUL", "new") for v in (10, 11, 3999) for r in target.where(f"visit = {v}").collect()] + [(9000, None, "insert", "FAILURE", "new")]
    source = spark.createDataFrame(batch + batch[:1], LOG)
    keys, cols = ["visit", "study", "method"], ["status", "note"]
    want = rows_of(merge_upsert(target, source.distinct(), keys, cols))
    made = V.merge(spark, log, source, keys, cols, "second")
    after = files(spark, log)
    assert rows_of(V.read(spark, log)) == want and made.number == 2
    kept = set(before) & set(after)
    assert len(kept) == 6                                   # visits 10 and 11 share a file, 3999 has its own
    rewritten = sum(size for path, size in after.items() if path not in kept)
    assert rewritten < 0.6 * sum(before.values())
    # A replay writes nothing; the first version still reads as it was.
    assert V.merge(spark, log, source, keys, cols, "second") == made
    assert files(spark, log) == after and V.versions(spark, log) == [1, 2]
    assert rows_of(V.read(spark, log, V.version(spark, log, 1))) == rows_of(target)


def test_merge_of_new_keys_rewrites_nothing(spark, log):
    before = files(spark, log)
    V.merge(spark, log, spark.createDataFrame([(-1, "s", "insert", "FAILURE", "new")], LOG), ["visit", "study", "method"], ["status", "note"], "b")
    assert set(before) < set(files(spark, log)) and V.read(spark, log).count() == 4001


def test_success_closes_rows_of_other_methods(spark, log):
    target = V.read(spark, log)
    failed = target.where("status = 'FAILURE'").first()
    other = "insert" if failed.method == "update" else "update"
    source = spark.createDataFrame([(failed.visit, failed.study, other, "SUCCESSFUL", "new")], LOG)
    from ledgerlight.operators import state
    args = (["visit", "study", "method"], ["status", "note"])
    closed = state._closed(target, source, ["visit", "study"], args[1], status="status")
    want = rows_of(merge_upsert(closed, source, *args))
    assert rows_of(closed) != rows_of(target)
    # merge() takes the log's own column names, so rename to them and back.
    named = scratch_path(spark, "named")
    V.overwrite(spark, named, target.withColumnRenamed("status", "responsestatus").repartitionByRange(8, "visit"), "first")
    before = files(spark, named)
    V.merge(spark, named, source.withColumnRenamed("status", "responsestatus"), args[0], ["responsestatus", "note"], "second", close_on=["visit", "study"])
    assert rows_of(V.read(spark, named).withColumnRenamed("responsestatus", "status")) == want
    assert len(set(before) & set(files(spark, named))) == 7


def test_failed_writer_leaves_the_version(spark, log):
    before = rows_of(V.read(spark, log))
    broken = spark.range(5).select(F.col("id").cast("int").alias("visit"), F.raise_error(F.lit("lost")).cast("string").alias("study"))
    with pytest.raises(Exception, match="lost"):
        V.append(spark, log, broken, "bad")
    assert V.current(spark, log).number == 1 and rows_of(V.read(spark, log)) == before
    assert V.append(spark, log, spark.createDataFrame([(5, "s")], "visit int, study string"), "bad").number == 2


def test_rival_writer_loses(spark, log):
    last = V.current(spark, log)
    listed = V.file_list(spark, log, last)
    V.publish(spark, log, listed, last.schema, "mine", last)
    with pytest.raises(V.ConcurrentWrite):
        V.publish(spark, log, listed.limit(0), last.schema, "theirs", last)
    assert V.current(spark, log).batch == "mine" and V.read(spark, log).count() == 4000


def test_columns_added_missing_and_widened(spark):
    root = scratch_path(spark, "evolving")
    with pytest.raises(ValueError, match="no version"):
        V.read(spark, root)
    V.append(spark, root, spark.createDataFrame([(1, 2, "a")], "id int, n int, t string"), "1")
    V.append(spark, root, spark.createDataFrame([(2 ** 40, 0.5)], "id long, extra double"), "2")
    V.append(spark, root, spark.createDataFrame([("z", 3)], "t string, id int"), "3")
    got = V.read(spark, root)
    assert got.schema.simpleString() == "struct<id:bigint,n:int,t:string,extra:double>"
    assert rows_of(got) == sorted([(1, 2, "a", None), (2 ** 40, None, None, 0.5), (3, None, "z", None)], key=str)
    with pytest.raises(V.SchemaConflict):
        V.append(spark, root, spark.createDataFrame([("x",)], "n string"), "4")
    assert rows_of(V.read(spark, root, V.version(spark, root, 1))) == [(1, 2, "a")]
    V.overwrite(spark, root, spark.createDataFrame([("new",)], "n string"), "5")
    assert rows_of(V.read(spark, root)) == [("new",)] and V.current(spark, root).number == 4


def test_empty_commits(spark):
    root = scratch_path(spark, "empty")
    none = spark.createDataFrame([], LOG)
    V.overwrite(spark, root, none, "1")
    assert V.read(spark, root).count() == 0
    V.merge(spark, root, none, ["visit"], ["status"], "2")
    V.merge(spark, root, spark.createDataFrame([(1, "s", "insert", "FAILURE", "x")], LOG), ["visit"], ["status"], "3")
    assert rows_of(V.read(spark, root)) == [(1, "s", "insert", "FAILURE", "x")]
