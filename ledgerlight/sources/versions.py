"""Tables as versions: a version is a list of data files, made current by one rename.

Layout below a table's root::

    data/<commit>/part-*.parquet     files of one commit, never changed
    lists/<commit>/                  the file list of a version (path, bytes), as Parquet
    versions/<number>.json           what a version is: its list, schema and batch

A writer first writes its data and its list, which nobody reads yet, and then renames a
small description to the next version number.  The rename fails if that number exists,
so of two writers one wins and the other must start again (``ConcurrentWrite``), and a writer
that dies before it leaves readers with the version they had.  (The store's rename
must be atomic, as on HDFS.)

A merge rewrites only the files that hold a row of the batch's keys; the list of
the next version carries all other files on as they are, so what is written follows
the batch, not the table.

Readers take the list and the schema of one version: columns that a file lacks
are NULL, narrower numbers are read as the wider type, columns are found by name.

Every commit names its batch.  A batch that a version already holds is not written
again: a replay returns that version.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIST_SCHEMA = "path string, bytes long"
#: Widenings that the Parquet reader does on the fly: from, to.
WIDER = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"),
         ("tinyint", "double"), ("smallint", "double"), ("int", "double"), ("float", "double"), ("date", "timestamp_ntz")}


class ConcurrentWrite(RuntimeError):
    """Another writer published the version number first."""


class SchemaConflict(ValueError):
    """A column's types cannot be reconciled."""


@dataclass(frozen=True)
class Version:
    number: int
    batch: str
    files: str                 # the list's folder, below the root
    schema: T.StructType


# ------------------------------------------------------------------ store

def _fs(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(conf), hpath


def _listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, bytes) of the files right below ``path``; none if it does not exist."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(hpath) if s.isFile() and not s.getPath().getName().startswith(("_", ".")))


def _rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file to a name that must not exist."""
    sc = spark.sparkContext
    jvm = sc._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(jvm.org.apache.hadoop.fs.Path(target).toUri(), sc._jsc.hadoopConfiguration())
    never = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target), never)
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            raise ConcurrentWrite(target) from e
        raise


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hpath = _fs(spark, path)
    out = fs.create(hpath, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


# --------------------------------------------------------------- versions

def versions(spark: SparkSession, root: str) -> list[int]:
    return [int(name.split(".")[0]) for name, _ in _listed(spark, f"{root}/versions") if name.endswith(".json")]


def version(spark: SparkSession, root: str, number: int) -> Version:
    text = spark.read.text(f"{root}/versions/{number:08d}.json", wholetext=True).first()[0]
    d = json.loads(text)
    return Version(number, d["batch"], d["files"], T.StructType.fromJson(d["schema"]))


def current(spark: SparkSession, root: str) -> Version | None:
    """The highest published version."""
    found = versions(spark, root)
    return version(spark, root, max(found)) if found else None


def holding(spark: SparkSession, root: str, batch: str) -> Version | None:
    """The version that a batch made, if there is one; newest first."""
    for number in sorted(versions(spark, root), reverse=True):
        v = version(spark, root, number)
        if v.batch == batch:
            return v
    return None


def file_list(spark: SparkSession, root: str, v: Version) -> DataFrame:
    """(path below the root, bytes) of a version's files."""
    return spark.read.schema(LIST_SCHEMA).parquet(f"{root}/{v.files}")


def read(spark: SparkSession, root: str, v: Version | None = None) -> DataFrame:
    """The rows of a version (the current one), in its schema."""
    v = v or current(spark, root)
    if v is None:
        raise ValueError(f"no version of {root} has been published")
    return _read_files(spark, root, [r["path"] for r in file_list(spark, root, v).collect()], v.schema)


def _read_files(spark: SparkSession, root: str, paths, schema: T.StructType) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{p}" for p in sorted(paths)])


def reconciled(old: T.StructType, new: T.StructType) -> T.StructType:
    """All columns of both, old ones first; a column of two types takes the wider."""
    out = []
    kinds = {f.name: f.dataType for f in new}
    for f in old:
        kind = kinds.pop(f.name, f.dataType)
        a, b = f.dataType.simpleString(), kind.simpleString()
        if a == b or (b, a) in WIDER:
            out.append(T.StructField(f.name, f.dataType, True))
        elif (a, b) in WIDER:
            out.append(T.StructField(f.name, kind, True))
        else:
            raise SchemaConflict(f"column {f.name}: {a} and {b}")
    return T.StructType(out + [T.StructField(n, k, True) for n, k in kinds.items()])


# ----------------------------------------------------------------- writing

def _write_data(df: DataFrame, root: str) -> list[tuple[str, int]]:
    commit = uuid.uuid4().hex[:16]
    df.write.mode("error").parquet(f"{root}/data/{commit}")
    return [(f"data/{commit}/{name}", size) for name, size in _listed(df.sparkSession, f"{root}/data/{commit}")]


def publish(spark: SparkSession, root: str, files: DataFrame, schema: T.StructType, batch: str, after: Version | None) -> Version:
    """Make ``files`` (path, bytes) the version after ``after``."""
    number, commit = (after.number + 1 if after else 1), uuid.uuid4().hex[:16]
    files.coalesce(1).write.mode("error").parquet(f"{root}/lists/{commit}")
    made = Version(number, batch, f"lists/{commit}", schema)
    text = json.dumps({"batch": batch, "files": made.files, "schema": schema.jsonValue()})
    _write_text(spark, f"{root}/lists/{commit}.json", text)
    fs, folder = _fs(spark, f"{root}/versions")
    fs.mkdirs(folder)
    _rename_new(spark, f"{root}/lists/{commit}.json", f"{root}/versions/{number:08d}.json")
    return made


def _commit(spark: SparkSession, root: str, kept: DataFrame | None, new: list[tuple[str, int]], schema: T.StructType, batch: str,
            after: Version | None) -> Version:
    files = spark.createDataFrame(new, LIST_SCHEMA)
    return publish(spark, root, kept.unionByName(files) if kept is not None else files, schema, batch, after)


def overwrite(spark: SparkSession, root: str, df: DataFrame, batch: str) -> Version:
    """A version of ``df`` alone, in its own schema.  Creates the table on first use."""
    done, last = holding(spark, root, batch), current(spark, root)
    return done or _commit(spark, root, None, _write_data(df, root), df.schema, batch, last)


def append(spark: SparkSession, root: str, df: DataFrame, batch: str) -> Version:
    """A version with the rows of ``df`` added, whose columns may be more, fewer or of
    wider or narrower types.  Creates the table on first use."""
    done = holding(spark, root, batch)
    if done:
        return done
    last = current(spark, root)
    schema = reconciled(last.schema, df.schema) if last else df.schema
    return _commit(spark, root, file_list(spark, root, last) if last else None, _write_data(df, root), schema, batch, last)


def merge(spark: SparkSession, root: str, source: DataFrame, keys, update_cols, batch: str, close_on=None, null_safe: bool = True) -> Version:
    """MERGE ``source`` (as ``state.merge_upsert``) into the current version.  Only
    files with a row that the batch can change are read whole and written anew; the
    others go on in the list.  Of source rows of one key the greatest of the other
    columns counts."""
    from ..operators.joins import first_per_key
    from ..operators.state import merge_upsert
    from ..session import ensure_checkpoint_dir
    done = holding(spark, root, batch)
    if done:
        return done
    last = current(spark, root)
    if last is None:
        raise ValueError(f"no version of {root} to merge into")
    ensure_checkpoint_dir(spark)
    source = first_per_key(source, keys, [c for c in source.columns if c not in keys], latest=True).checkpoint(eager=True)
    listed = file_list(spark, root, last)
    schema = reconciled(last.schema, source.schema)
    # Rows alike in these columns can change: with ``close_on``, all methods of a visit.
    alike = list(close_on or keys)
    asked = source.select(*[F.col(k).alias(f"k_{k}") for k in alike]).distinct()
    where = _read_files(spark, root, [r["path"] for r in listed.collect()], schema).select(
        *alike, F.regexp_extract(F.col("_metadata.file_path"), r"(data/[^/]+/[^/]+)$", 1).alias("path"))
    same = reduce(lambda a, b: a & b, [where[k].eqNullSafe(asked[f"k_{k}"]) if null_safe else where[k] == asked[f"k_{k}"] for k in alike])
    touched = where.join(asked, same, "left_semi").select("path").distinct()
    paths = [r["path"] for r in touched.collect()]                    # names of files, no rows
    rows = source.select(*[F.col(c) if c in source.columns else F.lit(None).cast(schema[c].dataType).alias(c) for c in schema.names])
    merged = merge_upsert(_read_files(spark, root, paths, schema), rows, keys, update_cols, null_safe=null_safe, close_on=close_on)
    kept = listed.where(~F.col("path").isin(paths)) if paths else listed
    return _commit(spark, root, kept, _write_data(merged, root), schema, batch, last)
