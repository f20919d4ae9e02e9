"""Helpers shared by the operators: reading, shared scratch tables, and
vectorised word hashing over Arrow text columns."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Bytes of text that a task hashes at a time (a longer single text is hashed alone).
SLICE_BYTES = 2 << 20


#: The folder that holds the package.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package when the session was started
    elsewhere: its folder goes on their path (executors must have it there)."""
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, path) if p)


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local master may go
    without one and gets a temporary folder; a cluster must name it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read
    it back with the schema it was written with."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of the broadcast that keeps most rows out of a shuffle.
CELLS = 1 << 20


def split_by_ids(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among ``ids``, rows whose key surely is not). Keys
    are told apart by one of ``CELLS`` hash cells, so the broadcast is bounded."""
    cell = F.pmod(F.xxhash64(key), F.lit(CELLS))
    cells = F.broadcast(ids.select(cell.alias("_cell")).distinct())
    marked = df.withColumn("_cell", cell)
    return (marked.join(cells, "_cell", "left_semi").drop("_cell"), marked.join(cells, "_cell", "left_anti").drop("_cell"))


#: The columns of ``documents``, which operators know by name.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_EXTRA = "_extra_column_"


def apart(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For functions of a table of documents (their first argument that is a table):
    its other columns travel under names of their own, so that none clashes with a working
    column, and come back under theirs. One named like a column that the function adds
    gives way to it. A table of ``DOCUMENT_COLUMNS`` alone goes in as it is."""
    @wraps(fn)
    def run(*args, **kwargs) -> DataFrame:
        at = next(i for i, a in enumerate(args) if isinstance(a, DataFrame))
        names = args[at].columns
        inside = [c if c in DOCUMENT_COLUMNS else f"{_EXTRA}{i}" for i, c in enumerate(names)]
        if inside == names:
            return fn(*args, **kwargs)
        if kwargs.get("keep"):
            kwargs = kwargs | {"keep": [dict(zip(names, inside))[c] for c in kwargs["keep"]]}
        out = fn(*args[:at], args[at].toDF(*inside), *args[at + 1:], **kwargs)
        back = {a: b for a, b in zip(inside, names) if a != b}
        added = {c.lower() for c in out.columns if c not in back}
        return out.select(*[F.col(c).alias(back.get(c, c)) for c in out.columns if back.get(c, "").lower() not in added])
    return run


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, in whatever store it is."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


# --- words of UTF-8 text, vectorised ------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]      # A-Z hash as a-z
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
_ORDER = _rng.integers(0, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows with at most
    ``limit`` bytes of text together, or one longer row. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, off, buf = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word ``[^\\x20\\x09-\\x0D]+``, and per text the
    index of its first word (one entry more than texts)."""
    space = _SPACE[data]
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = True, space
    after = np.empty(len(data) + 1, bool)
    after[-1], after[:-1] = True, space
    before[offsets] = True
    after[offsets] = True
    starts = np.flatnonzero(~space & before[:-1])
    ends = np.flatnonzero(~space & after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word, the same for A-Z and a-z."""
    run = np.empty(len(data) + 1, np.uint64)
    run[0] = 0
    np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=run[1:])
    inverse = _power(_BASE_INV, len(data) + 1)
    return mix((run[ends] - run[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; fewer words are one run."""
    if not len(words):
        return words
    n = min(n, len(words))
    order = _ORDER if n <= len(_ORDER) else np.resize(_ORDER, n) + np.arange(n, dtype=np.uint64) * U64(2)
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total += words[i:len(words) - n + 1 + i] * order[i]
    return mix(total)
