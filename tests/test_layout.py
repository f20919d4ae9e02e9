"""The clustered layout: what a scan reads for filters on one column, by its own counts."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlight.operators import layout as LY
from ledgerlight.session import scratch_path


def rows_scanned(df):
    """Rows that the plan's scans gave out, from the metrics of a finished run."""
    plan = df._jdf.queryExecution()
    plan.executedPlan().executeCollectPublic()
    total, todo = 0, [plan.executedPlan()]
    while todo:
        p = todo.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if p.nodeName().startswith("Scan"):
            total += p.metrics().apply("numOutputRows").value()
        if p.nodeName().endswith("QueryStage"):
            todo.append(p.plan())
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return total


def fact(spark):
    days = F.lit(dt.date(2000, 1, 1))
    return spark.range(40000).select(F.date_add(days, (F.xxhash64("id", F.lit(1)) % 365).cast("int")).alias("d"),
                                     F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(500))).cast("long").alias("store"),
                                     F.pmod(F.xxhash64("id", F.lit(3)), F.lit(900)).alias("part"), (F.col("id") % 100).alias("v"))


def test_each_filter_alone_reads_a_part(spark):
    df = fact(spark)
    path = scratch_path(spark, "z")
    LY.write_clustered(df, ["d", "store", "part"], path, 64)
    # By minima and maxima alone: a file's dictionary, read too, would cut further.
    by_range = spark.read.schema(df.schema).option("parquet.filter.dictionary.enabled", "false")
    kept = by_range.parquet(path)
    assert kept.exceptAll(df).isEmpty() and df.exceptAll(kept).isEmpty()
    one = F.col("d").between(dt.date(2000, 6, 1), dt.date(2000, 6, 10))
    for cond, share in ((one, 0.6), (F.col("store") == 300, 0.6), (F.col("part") == 450, 0.6), (one & (F.col("store") == 300), 0.3)):
        picked = kept.where(cond)
        assert picked.count() == df.where(cond).count()
        assert rows_scanned(picked) < share * 40000
    # The plain order serves the first column only.
    plain = scratch_path(spark, "plain")
    df.repartitionByRange(64, "d", "store").write.parquet(plain)
    assert rows_scanned(by_range.parquet(plain).where("store = 300")) > 0.9 * 40000
    # A store with a third of the lines is no single file.
    assert kept.where("store = 7").select("_metadata.file_path").distinct().count() > 8


def test_interleaved_bits_and_places(spark):
    row = spark.range(1).select(LY.interleaved([F.lit(0b101), F.lit(0b011)], 3).alias("k")).first()
    assert row.k == 0b100111
    got = [r.p for r in spark.createDataFrame([(None,), (-1,), (0,), (5,), (9,), (99,)], "x int").select(LY.place_among("x", [0, 4, 9]).alias("p")).collect()]
    assert got == [0, 0, 0, 2, 2, 3]


def test_empty_table_and_blank_columns(spark):
    path = scratch_path(spark, "z")
    df = spark.createDataFrame([(None, None, 1), (None, 3, 2)], "d date, store long, v int")
    LY.write_clustered(df, ["d", "store"], path, 4)
    assert spark.read.parquet(path).count() == 2
    LY.write_clustered(df.limit(0), ["d", "store"], scratch_path(spark, "z"), 4)
