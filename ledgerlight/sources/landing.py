"""Landed API pages and sheets.

The API client is outside Spark: it lands every page of every study as a
JSON document ``{data: [...], metadata: {timestamp}, pagination:
{totalPages}}`` under ``<root>/study=<key>/``.  Ingest is then one
``read.json`` over all pages of all studies (no per-page loop, no per-page
write), an ``explode`` of the data array, the study key taken from the file
path, and a cast to the target schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STUDY_FROM_PATH = r"study=([^/]+)"


def envelope_schema(data_fields) -> T.StructType:
    row = T.StructType([T.StructField(f, T.StringType(), True) for f in data_fields])
    return T.StructType([
        T.StructField("data", T.ArrayType(row), True),
        T.StructField("metadata", T.StructType([T.StructField("timestamp", T.StringType(), True)]), True),
        T.StructField("pagination", T.StructType([T.StructField("totalPages", T.IntegerType(), True)]), True),
    ])


def land_pages(rows: DataFrame, study_col: str, page_col: str, stamp_col: str, data_fields, out: str,
               ) -> str:
    """Write ``rows`` as landed pages (one JSON document per (study, page);
    a page holds the rows sharing ``page_col``, so its size is bounded by
    the page numbering, not by the study's size)."""
    pages = rows.groupBy(study_col, page_col).agg(
        F.collect_list(F.struct(*[F.col(f).cast("string").alias(f) for f in data_fields])).alias("data"),
        F.max(stamp_col).alias("_ts"))
    totals = rows.groupBy(study_col).agg(F.count_distinct(page_col).cast("int").alias("totalPages"))
    env = pages.join(totals, study_col).select(
        F.col(study_col).alias("study"), "data",
        F.struct(F.col("_ts").cast("string").alias("timestamp")).alias("metadata"),
        F.struct("totalPages").alias("pagination"))
    env.write.mode("overwrite").partitionBy("study").json(out)
    return out


def read_envelopes(spark: SparkSession, path: str, data_fields) -> DataFrame:
    """One row per landed page, with the study key from the file path."""
    raw = (spark.read.schema(envelope_schema(data_fields)).option("recursiveFileLookup", "true").json(path)
           .select("*", F.col("_metadata.file_path").alias("_path")))
    return raw.select("data", F.col("metadata.timestamp").alias("timestamp"),
                      F.col("pagination.totalPages").alias("total_pages"),
                      F.regexp_extract("_path", STUDY_FROM_PATH, 1).alias("studyKey"))


def read_pages(spark: SparkSession, path: str, data_fields) -> DataFrame:
    """All landed pages -> one row per data element, with the page
    timestamp, the page count and the study key."""
    env = read_envelopes(spark, path, data_fields)
    return (env.select("studyKey", F.explode("data").alias("r"), "timestamp", "total_pages")
               .select("studyKey", "r.*", "timestamp", "total_pages"))


def cast_to_schema(df: DataFrame, schema: dict) -> DataFrame:
    """Cast every listed column to its type (failed cells become NULL);
    other columns pass through."""
    return df.select(*[F.col(c).try_cast(schema[c]).alias(c) if c in schema else F.col(c) for c in df.columns])


def page_status(envelopes: DataFrame, study_col: str = "studyKey") -> DataFrame:
    """Per study: pages expected (from the envelope) vs pages found; a
    study with a missing page is reported as incomplete."""
    return (envelopes.groupBy(study_col)
            .agg(F.max("total_pages").alias("expected_pages"), F.count(F.lit(1)).alias("pages_found"))
            .withColumn("complete", F.col("pages_found") >= F.col("expected_pages")))


def read_sheet_as_strings(spark: SparkSession, path: str) -> DataFrame:
    """A delimited sheet with a header, every column as text; the text
    'nan' (a missing number written by a dataframe library) becomes NULL."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.select(*[F.when(F.col(c) == "nan", F.lit(None)).otherwise(F.col(c).cast("string")).alias(c)
                       for c in df.columns])


# ------------------------------------------- numbered pages, damaged or absent

def land_numbered_pages(rows: DataFrame, study_col: str, page_col: str, data_fields, out: str, absent=None, cut_short=None, garbled=None) -> str:
    """``rows`` as landed pages that carry their number (0-based) and the count of
    pages.  ``absent``, ``cut_short`` and ``garbled`` are conditions on the study
    and page columns: such a page is not landed, ends in the middle of its data, or is no
    JSON at all."""
    never = F.lit(False)
    absent, cut_short, garbled = (c if c is not None else never for c in (absent, cut_short, garbled))
    pages = rows.groupBy(study_col, page_col).agg(F.collect_list(F.struct(*[F.col(f).cast("string").alias(f) for f in data_fields])).alias("data"))
    totals = rows.groupBy(study_col).agg((F.max(page_col) + 1).cast("int").alias("totalPages"))
    text = F.to_json(F.struct(F.struct(F.col(page_col).cast("int").alias("page"), "totalPages").alias("pagination"), "data"))
    text = F.when(garbled, F.concat(F.lit("<html>"), F.col(page_col).cast("string"))).when(
        cut_short, F.substring(text, F.lit(1), F.length(text) - 2)).otherwise(text)
    (pages.join(totals, study_col).where(~absent).select(F.col(study_col).alias("study"), text.alias("value"))
     .write.mode("error").partitionBy("study").text(out))
    return out


def read_checked(spark: SparkSession, path: str, data_fields) -> DataFrame:
    """One row per landed page: studyKey, page, total_pages, data, and ``bad``, the
    text of a page that does not parse.  A page cut short still tells its number, as far as
    its text goes; the numbers of other bad pages are NULL."""
    row = T.StructType([T.StructField(f, T.StringType(), True) for f in data_fields])
    number = T.StructType([T.StructField("page", T.IntegerType(), True), T.StructField("totalPages", T.IntegerType(), True)])
    schema = T.StructType([T.StructField("pagination", number, True), T.StructField("data", T.ArrayType(row), True), T.StructField("_bad", T.StringType(), True)])
    raw = (spark.read.schema(schema).option("recursiveFileLookup", "true").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_bad").json(path).select("*", F.col("_metadata.file_path").alias("_path")))
    said = lambda name: F.regexp_extract("_bad", rf'"{name}":(\d+)[,}}]', 1).try_cast("int")
    good = F.col("_bad").isNull()
    return raw.select(F.regexp_extract("_path", STUDY_FROM_PATH, 1).alias("studyKey"),
                      F.when(good, F.col("pagination.page")).otherwise(said("page")).alias("page"),
                      F.when(good, F.col("pagination.totalPages")).otherwise(said("totalPages")).alias("total_pages"),
                      F.when(good, F.col("data")).alias("data"), F.col("_bad").alias("bad"))


def page_faults(pages: DataFrame) -> DataFrame:
    """Per study, runs of pages that are not there whole: kind (``missing``: no landed page
    says that number; ``damaged``: the page does not parse), first_page, last_page and
    n_pages.  Damaged pages without a number are one row with NULL pages; which
    numbers they had, is among the missing ones.  Pages landed twice count once; a page
    that also landed whole is not damaged.  A study none of whose pages tells the count has
    no missing pages that could be told.

    Runs are found without ordering a study's pages: a page that is there begins a gap where its
    successor is not, and ends one where its predecessor is not (two anti joins by
    study and number); only the ends of gaps are numbered and paired."""
    known = pages.where("page IS NOT NULL").groupBy("studyKey", "page").agg(F.max(F.col("bad").isNull()).alias("whole"))
    total = pages.groupBy("studyKey").agg(F.max("total_pages").alias("total"))
    there = known.select("studyKey", "page").join(total, "studyKey").where("total IS NOT NULL")
    edges = total.where("total IS NOT NULL")
    before = there.select("studyKey", "page", "total").unionByName(edges.select("studyKey", F.lit(-1).alias("page"), "total"))
    after = there.select("studyKey", "page", "total").unionByName(edges.select("studyKey", F.col("total").alias("page"), "total"))
    begin = (before.withColumn("page", F.col("page") + 1).where("page < total")
             .join(there.select("studyKey", "page"), ["studyKey", "page"], "left_anti"))
    end = after.withColumn("page", F.col("page") - 1).where("page >= 0 AND page < total").join(there.select("studyKey", "page"), ["studyKey", "page"], "left_anti")
    missing = _runs(begin.select("studyKey", "page"), end.select("studyKey", "page")).select("studyKey", F.lit("missing").alias("kind"), "first_page", "last_page")
    broken = known.where("NOT whole").select("studyKey", "page")
    step = lambda by: broken.select("studyKey", (F.col("page") + by).alias("page"))
    first = broken.join(step(1), ["studyKey", "page"], "left_anti")
    last = broken.join(step(-1), ["studyKey", "page"], "left_anti")
    damaged = _runs(first, last).select("studyKey", F.lit("damaged").alias("kind"), "first_page", "last_page")
    runs = missing.unionByName(damaged).withColumn("n_pages", (F.col("last_page") - F.col("first_page") + 1).cast("long"))
    unknown = (pages.where("page IS NULL AND bad IS NOT NULL").groupBy("studyKey").agg(F.count(F.lit(1)).alias("n_pages"))
               .select("studyKey", F.lit("damaged").alias("kind"), F.lit(None).cast("int").alias("first_page"), F.lit(None).cast("int").alias("last_page"), "n_pages"))
    return runs.unionByName(unknown)


def _runs(first: DataFrame, last: DataFrame) -> DataFrame:
    """The k-th first page of a study with its k-th last page."""
    place = F.row_number().over(Window.partitionBy("studyKey").orderBy("page"))
    a = first.distinct().select("studyKey", F.col("page").alias("first_page"), place.alias("k"))
    b = last.distinct().select("studyKey", F.col("page").alias("last_page"), place.alias("k"))
    return a.join(b, ["studyKey", "k"]).drop("k")


def whole_rows(pages: DataFrame) -> DataFrame:
    """Every data element of the pages that parse; bad pages are routed to ``page_faults``."""
    return pages.where("bad IS NULL").select("studyKey", "page", F.explode("data").alias("r")).select("studyKey", "page", "r.*")
