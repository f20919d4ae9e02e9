import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlight.operators import rank as RK
from ledgerlight.operators import state as ST
from ledgerlight.operators.joins import first_per_key


def test_global_rank_matches_window(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([None, *range(40)])) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, v long")
    for method, fn in (("dense", F.dense_rank()), ("skip", F.rank())):
        for asc in (False, True):
            got = {r.id: r.rk for r in RK.global_rank(df, "v", "rk", method=method, ascending=asc,
                                                    partitions=5).collect()}
            w = Window.orderBy(F.col("v").asc() if asc else F.col("v").desc())
            ref = df.where("v IS NOT NULL").withColumn("rk", fn.over(w))
            exp = {r.id: r.rk for r in ref.collect()}
            for i, v in rows:
                assert got[i] == (exp[i] if v is not None else None), (method, asc, i)


def test_member_at_rank_ties(spark):
    df = spark.createDataFrame([("p", "a", 10.0), ("p", "b", 10.0), ("p", "c", 5.0), ("q", "a", 1.0)],
                               "product string, retailer string, s double")
    ranked = RK.group_rank(df, ["product"], "s", "rk", method="skip")
    out = {(r.product, r.k): r.retailer_at_k for r in RK.member_at_rank(ranked, ["product"], "rk", "retailer",
                                                                         (1, 2, 3)).collect()}
    assert out == {("p", 1): None, ("p", 2): None, ("p", 3): "c", ("q", 1): "a", ("q", 2): None, ("q", 3): None}


def test_first_per_key_latest(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 3, "new"), ("j", 2, "only")], "k string, t int, v string")
    got = {r.k: r.v for r in first_per_key(df, ["k"], ["t"], latest=True).collect()}
    assert got == {"k": "new", "j": "only"}


SCHEMA = "s string, st string, v string, m string, status string, err string, n int"


def test_merge_null_safe(spark):
    target = spark.createDataFrame([("A", "x", None, "insert", "FAILURE", "e1", 1),
                                    ("B", "x", "2", "insert", "SUCCESSFUL", None, 1)], SCHEMA)
    source = spark.createDataFrame([("A", "x", None, "insert", "SUCCESSFUL", None, 2),
                                    ("C", "x", "3", "update", "SUCCESSFUL", None, 2)], SCHEMA)
    keys, upd = ["s", "st", "v", "m"], ["status", "err", "n"]
    safe = sorted(tuple(r) for r in ST.merge_upsert(target, source, keys, upd).collect())
    assert safe == [("A", "x", None, "insert", "SUCCESSFUL", None, 2), ("B", "x", "2", "insert", "SUCCESSFUL", None, 1),
                    ("C", "x", "3", "update", "SUCCESSFUL", None, 2)]
    plain = ST.merge_upsert(target, source, keys, upd, null_safe=False).collect()
    assert len(plain) == 4  # the NULL-key row is inserted again, as with a plain equality key


def test_merge_dedupes_source(spark):
    target = spark.createDataFrame([("A", "x", "1", "insert", "FAILURE", "e", 1)], SCHEMA)
    source = spark.createDataFrame([("A", "x", "1", "insert", "FAILURE", "e2", 2),
                                    ("A", "x", "1", "insert", "SUCCESSFUL", None, 3)], SCHEMA)
    out = ST.merge_upsert(target, source, ["s", "st", "v", "m"], ["status", "err", "n"], order_col="n").collect()
    assert [(r.status, r.n) for r in out] == [("SUCCESSFUL", 3)]


def test_delete_truncate_watermark(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "i int, c string")
    assert sorted(r.i for r in ST.delete_where(df, F.col("c") == "a").collect()) == [2, 3]
    assert ST.truncate(df).count() == 0 and ST.truncate(df).schema == df.schema
    cfg = spark.createDataFrame([("t1", "2024-01-01 00:00:00"), ("t2", "x")], "Table string, Latest_Date string")
    adv = {r.Table: r.Latest_Date for r in ST.advance_table_watermark(cfg, "t1", F.lit("2024-02-01 00:00:00"),
                                                                      F.lit(0)).collect()}
    assert adv["t1"] == "2024-01-01 00:00:00"  # no success: unchanged
    adv = {r.Table: r.Latest_Date for r in ST.advance_table_watermark(cfg, "t1", F.lit("2024-02-01 00:00:00"),
                                                                      F.lit(2)).collect()}
    assert adv == {"t1": "2024-02-01 00:00:00", "t2": "x"}
    win = ST.extraction_windows(cfg, F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")).collect()
    assert [r.table_name for r in win] == ["t1"]  # unparsable watermark skipped
    assert win[0].filter.startswith("dateCreated>2024-01-01T00:00:00Z and dateCreated<2024-03-01T00:00:00Z")


def test_change_window_bounds(spark):
    df = spark.createDataFrame([(1, 5), (5, 1), (10, 10), (3, 3)], "c int, m int")
    lo, hi = F.lit(1), F.lit(10)
    strict = sorted((r.c, r.m) for r in df.where(ST.in_change_window(F.col("c"), F.col("m"), lo, hi, strict=True)).collect())
    assert strict == [(1, 5), (3, 3), (5, 1)]
    half = sorted((r.c, r.m) for r in df.where(ST.in_change_window(F.col("c"), F.col("m"), lo, hi)).collect())
    assert half == [(1, 5), (3, 3), (5, 1), (10, 10)]


def test_consecutive_windows_lose_no_row(spark):
    df = spark.range(1, 31).select(F.col("id").alias("c"), F.col("id").alias("m"))
    seen = []
    for lo, hi in ((0, 10), (10, 20), (20, 30)):
        seen += [r.c for r in df.where(ST.in_change_window(F.col("c"), F.col("m"), F.lit(lo), F.lit(hi))).collect()]
    assert sorted(seen) == list(range(1, 31))


def test_run_log_statuses(spark):
    import datetime as dt
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    per = spark.createDataFrame([("sites", 5, t0, t1, None), ("visits", 0, t0, t1, None),
                                 ("records", 3, t0, t1, "page 2 of 3 missing")],
                                "table string, row_count long, start_time timestamp_ntz, end_time timestamp_ntz, err string")
    rows = {r.table: r for r in ST.run_log(per, "Bronze", "api", error_col="err").collect()}
    ok = rows["sites"]
    assert (ok.etl_status, ok.status_code, ok.custom_description) == ("Success", 200, "API Execution")
    assert rows["visits"].custom_description == "No data available" and rows["visits"].log_type == "ETL"
    r = rows["records"]
    assert (r.log_type, r.etl_status, r.status_code, r.error) == ("Error", "Fail", 500, "page 2 of 3 missing")
    assert r.custom_description == "Exception occurred: page 2 of 3 missing"


def test_advance_sync_watermark(spark):
    import datetime as dt
    cfg = spark.createDataFrame([("subject_visits", dt.datetime(2024, 1, 1))], "table_name string, last_sync timestamp_ntz")
    new = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    assert ST.advance_sync_watermark(cfg, "subject_visits", new, F.lit(0)).first().last_sync == dt.datetime(2024, 1, 1)
    assert ST.advance_sync_watermark(cfg, "subject_visits", new, F.lit(3)).first().last_sync == dt.datetime(2024, 2, 1)


def test_merge_writes_a_new_version(spark, tmp_out):
    schema = "subjectKey string, study_key string, visit_instance_id string, method string, responsestatus string"
    log = spark.createDataFrame([("K1", "A", "1", "insert", "FAILURE"), ("K2", "A", "2", "insert", "SUCCESSFUL"),
                                 ("K3", "B", "3", "insert", "FAILURE"), ("K5", None, "5", "insert", "FAILURE")], schema)
    log.write.partitionBy("study_key").parquet(tmp_out + "/v0")
    old = spark.read.parquet(tmp_out + "/v0")
    # A key that the batch repeats, and a success by another method.
    batch = spark.createDataFrame([("K1", "A", "1", "update", "SUCCESSFUL"), ("K4", "A", "4", "insert", "FAILURE"),
                                   ("K4", "A", "4", "insert", "SUCCESSFUL"), ("K5", None, "5", "insert", "SUCCESSFUL")], schema)
    keys = ["subjectKey", "study_key", "visit_instance_id", "method"]
    for _ in range(2):                                   # a replayed batch writes the same version
        new = ST.merge_to_next_version(old, batch, tmp_out + "/v1", keys, ["responsestatus"], "study_key", close_on=keys[:3])
        assert sorted(map(str, (tuple(r) for r in new.select(*log.columns).collect()))) == sorted(map(str, [
            ("K1", "A", "1", "insert", "SUCCESSFUL"), ("K1", "A", "1", "update", "SUCCESSFUL"), ("K2", "A", "2", "insert", "SUCCESSFUL"),
            ("K3", "B", "3", "insert", "FAILURE"), ("K4", "A", "4", "insert", "SUCCESSFUL"), ("K5", None, "5", "insert", "SUCCESSFUL")]))
    assert old.count() == 4                              # readers keep the version they had


def test_row_numbers_with_ties_and_missing_keys(spark):
    from ledgerlight.operators.quality import type_mismatch_quarantine
    from ledgerlight.operators.rank import global_row_number
    rows = [("abc", "1")] + [("5", str(i)) for i in range(40)] + [("7", "x"), (None, "y"), ("3", "1")]
    raw = spark.createDataFrame(rows, "k string, v string").withColumn("n", F.col("k").try_cast("int")).repartition(5)
    numbered = global_row_number(raw.select("n"), ["n"]).collect()
    assert sorted(r.row_no for r in numbered) == list(range(1, 45))
    assert [r.n for r in sorted(numbered, key=lambda r: r.row_no)] == [3] + [5] * 40 + [7, None, None]
    bad = {(r.k, r.v): (r.row_no, r.bad_columns) for r in type_mismatch_quarantine(raw, {"k": "int", "v": "int"}, ["n", "k", "v"]).collect()}
    assert bad == {("7", "x"): (42, "v"), ("abc", "1"): (43, "k"), (None, "y"): (44, "v")}


def test_read_watermark_default(spark):
    import datetime as dt

    from ledgerlight.sources.clinical import DEFAULT_WATERMARK
    empty = spark.createDataFrame([], "table_name string, last_sync timestamp_ntz")
    assert ST.read_watermark(empty, "subject_visits", DEFAULT_WATERMARK).first().watermark == dt.datetime(2023, 10, 2)
    null_row = spark.createDataFrame([("subject_visits", None)], "table_name string, last_sync timestamp_ntz")
    assert ST.read_watermark(null_row, "subject_visits", DEFAULT_WATERMARK).first().watermark == dt.datetime(2023, 10, 2)
    other = spark.createDataFrame([("other", dt.datetime(2024, 1, 1))], "table_name string, last_sync timestamp_ntz")
    assert ST.read_watermark(other, "subject_visits", DEFAULT_WATERMARK).first().watermark == dt.datetime(2023, 10, 2)


def test_join_dim_bounded_count_broadcast(spark):
    from ledgerlight.operators.joins import join_dim
    fact = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    small = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a"))
    big = spark.range(5000).select((F.col("id") % 50).alias("k"), F.col("id").alias("a"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = join_dim(fact, small, "k", max_rows=100)._jdf.queryExecution().executedPlan().toString()
        unhinted = join_dim(fact, big, "k", max_rows=100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in hinted
    assert "BroadcastHashJoin" not in unhinted
