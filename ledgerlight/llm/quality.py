"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Terms are hashed words, hashed word shapes (letter case, digits and punctuation
in order, runs as one) and a mark for a word that repeats the one before.
Document frequencies come from all documents. A bounded, balanced sample of
labelled rows (``SAMPLE``) gives a TF-IDF matrix whose leading ``RANK`` singular
directions are the latent space; the sample's vectors, ``SAMPLE`` x ``RANK`` numbers,
are broadcast. Every document is mapped to that space and compared with all of
them by exact cosine products, block by block; its ``NEIGHBOURS`` nearest vote with the
fourth power of their similarity (0 if it is negative). One scan, no shuffle.

Defined cases: a text without words (null too) gets the mean label of the learned
texts without words, or 0 if there are none; a text that is orthogonal to every
labelled one gets the sample's mean label; without labels every score is 0.5; several
labels of one document are averaged; null labels and rows without ``doc_id`` are not learned
from; ``documents`` rows of one id are scored one by one; of labelled rows equally near at the
last place a selection votes that the sample's order settles, the same for equal texts; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, apart, mix, slices, word_hashes, word_spans

DIM, SHAPES = 1 << 13, 1 << 10
SAMPLE, RANK, NEIGHBOURS = 2400, 64, 15
ACCEPT = 0.7
CHUNK_DOCS = 128

_CLASS = np.arange(256, dtype=np.uint64) + U64(16)
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("a"):ord("z") + 1] = 2
_CLASS[0x80:] = 2
_CLASS[ord("0"):ord("9") + 1] = 3


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash per word of its character classes in order, runs as one."""
    kind = _CLASS[data]
    new = np.ones(len(data), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[starts] = True
    at = np.flatnonzero(new)
    a, b = np.searchsorted(at, starts), np.searchsorted(at, ends)
    out, kinds = np.zeros(len(starts), np.uint64), kind[at]
    for i in range(8):                                   # shapes of more than eight runs end in their first eight
        more = a + i < b
        out[more] = out[more] * U64(257) + kinds[a[more] + i]
    return mix(out)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of texts, text index, term, count, whether a text has words)."""
    starts, ends, first = word_spans(data, offsets)
    words, shapes = word_hashes(data, starts, ends), _shapes(data, starts, ends)
    terms = (words % U64(DIM - SHAPES)).astype(np.int64)
    marks = DIM - SHAPES + 1 + (shapes % U64(SHAPES - 1)).astype(np.int64)
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    again[first[:-1][first[:-1] < len(words)]] = False
    for a in range(0, len(offsets) - 1, CHUNK_DOCS):
        cut = first[a:a + CHUNK_DOCS + 1]
        doc = np.repeat(np.arange(len(cut) - 1), np.diff(cut)) * DIM
        own = slice(cut[0], cut[-1])
        cells = np.concatenate([doc + terms[own], doc + marks[own], doc[again[own]] + (DIM - SHAPES)])
        counts = np.bincount(cells, minlength=1)
        at = np.flatnonzero(counts)
        yield len(cut) - 1, at // DIM, at % DIM, counts[at], np.diff(cut) > 0


def _all(texts: pa.Array) -> Iterator:
    for _, _, data, offsets in slices(texts):
        yield from features(data, offsets)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, docs = np.zeros(DIM, np.int64), 0
    for batch in batches:
        for n, _, term, _, _ in _all(batch.column("text")):
            df += np.bincount(term, minlength=DIM)
            docs += n
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], docs))], names=["term", "df"])


def idf_of(docs: DataFrame) -> np.ndarray:
    rows = docs.select("text").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    found = {r["term"]: r["df"] for r in rows}
    df = np.array([found.get(i, 0) for i in range(DIM)], float)
    return (np.log((1 + found.get(-1, 0)) / (1 + df)) + 1).astype(np.float32)


def _dense(n: int, doc: np.ndarray, term: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows with sublinear counts and length 1."""
    out = np.zeros((n, DIM), np.float32)
    out[doc, term] = (1 + np.log(count)) * idf[term]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms, counts = [], []
        for n, doc, term, count, _ in _all(batch.column("text")):
            cuts = np.searchsorted(doc, np.arange(1, n))
            terms += np.split(term.astype(np.int32), cuts)
            counts += np.split(count.astype(np.int32), cuts)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_label"), batch.column("_h"), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
            names=["label", "h", "terms", "counts"])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class Model:
    """Term weights, latent space, and the labelled vectors."""

    def __init__(self, idf: np.ndarray, space: np.ndarray, vectors: np.ndarray, labels: np.ndarray, wordless: float):
        self.idf, self.space, self.vectors, self.labels, self.wordless = idf, space, vectors, labels, wordless

    def score(self, texts: pa.Array) -> np.ndarray:
        out = []
        k = min(NEIGHBOURS, len(self.labels))
        for n, doc, term, count, some in _all(texts):
            z = _unit(_dense(n, doc, term, count, self.idf) @ self.space)
            near = z @ self.vectors.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(float) ** 4
            total = weight.sum(axis=1)
            vote = (weight * self.labels[best]).sum(axis=1) / np.maximum(total, 1e-12)
            out.append(np.where(some, np.where(total > 1e-9, vote, self.labels.mean()), self.wordless))
        return np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0)


def _latent(rows: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular directions by a seeded subspace iteration."""
    rank = min(rank, *rows.shape)
    q = np.random.default_rng(9).standard_normal((rows.shape[1], min(rank + 16, *rows.shape))).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(rows.T @ (rows @ q))
    small = rows @ q
    _, _, v = np.linalg.svd(small, full_matrices=False)
    return np.ascontiguousarray((q @ v.T)[:, :rank])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Model | None:
    """``docs`` (doc_id, text), ``labels`` (doc_id, quality). Learns from at
    most ``sample`` labelled rows for which ``learn`` holds, half of each label."""
    known = (labels.where(F.col("quality").isNotNull() & learn).groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("_label"))
             .withColumn("_h", F.xxhash64("doc_id", F.lit(31))))
    halves = [known.where(side).orderBy("_h", "doc_id").limit(sample // 2) for side in (F.col("_label") >= 0.5, F.col("_label") < 0.5)]
    picked = halves[0].unionByName(halves[1])
    # ``sample`` rows are broadcast: no text is shuffled.
    rows = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("_label", "_h", "text")
            .mapInArrow(_sparse, "label double, h long, terms array<int>, counts array<int>").orderBy("h").limit(sample).collect())
    if not rows:
        return None
    idf = idf_of(docs)
    wordless = [r["label"] for r in rows if not r["terms"]]
    rows = [r for r in rows if r["terms"]]
    if not rows:
        return Model(idf, np.zeros((DIM, 1), np.float32), np.zeros((1, 1), np.float32), np.array([float(np.mean(wordless))]), float(np.mean(wordless)))
    matrix = np.zeros((len(rows), DIM), np.float32)
    for i, r in enumerate(rows):
        term = np.array(r["terms"])
        matrix[i] = _dense(1, np.zeros(len(term), int), term, np.array(r["counts"]), idf)[0]
    space = _latent(matrix, RANK)
    return Model(idf, space, _unit(matrix @ space), np.array([r["label"] for r in rows]), float(np.mean(wordless)) if wordless else 0.0)


@apart
def scored(docs: DataFrame, model: Model | None, accept: float = ACCEPT, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``quality_score`` and ``quality_pred`` (1 if the score is
    at least ``accept``); of its columns only ``keep``, if given."""
    keep = keep or docs.columns
    if model is None:
        out = docs.select(*keep).withColumn("quality_score", F.lit(0.5))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                score = pa.array(shared.value.score(batch.column("text")), pa.float64())
                yield batch.select(keep).append_column("quality_score", score)

        kind = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes if n in keep)
        out = docs.mapInArrow(run, f"{kind}, quality_score double")
    return out.withColumn("quality_pred", (F.col("quality_score") >= accept).cast("int"))
