"""Language identification: sparse multinomial logistic regression on TF-IDF of
character n-grams, trained by follow-the-regularised-leader with elastic-net
penalties, then calibrated by a temperature.

Document frequencies come from all rows that may be learned from (text and language
known), pre-aggregated per task. The model is fitted on a hash sample of labelled rows, at most about
``PER_LANGUAGE`` a language and ``MAX_TRAIN`` in all: with more than
``MAX_TRAIN / PER_LANGUAGE`` languages each gives fewer, all down to the same number,
and about ``LEAST`` each at least, even if the whole is more then. A fifth of it is
kept out of training to fit the temperature. Every document is then scored whole in
one scan without a shuffle: texts are featurised chunk by chunk, so memory is that of
``CHUNK_CHARS`` characters (or of one longer text).

Defined cases: null texts and texts without a letter are ``und`` with score 0;
so is everything if no labelled text has a letter; rows without ``doc_id`` are
scored, not learned from; repeated rows are scored alike; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

DIM = 1 << 14
ORDERS = (1, 2, 3)
CHUNK_DOCS, CHUNK_CHARS = 128, 1 << 20
PER_LANGUAGE, MAX_TRAIN = 300, 6000
LEAST = 20
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.02, 0.02, 4
UNKNOWN = "und"
_ODD = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


@lru_cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    at, held, chars = 0, [], 0
    for i, t in enumerate(texts):
        t = t or ""
        if held and (len(held) == CHUNK_DOCS or chars + len(t) > CHUNK_CHARS):
            yield at, held
            at, held, chars = i, [], 0
        held.append(t.lower())
        chars += len(t)
    if held:
        yield at, held


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse counts of hashed character n-grams of a chunk: document index,
    n-gram index and count of every cell above 0, and whether a text has a letter.
    Runs of anything but letters count as one space."""
    lens = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), lens)
    letter = _letters()[points]
    has = np.zeros(len(texts), bool)
    has[doc[letter]] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1]                      # the first character after a letter stands for the gap
    points, doc = np.where(letter, points, 32)[keep], doc[keep]
    cells = []
    h = np.zeros(len(points), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if n > 1:
            if len(points) < n:
                break
            h = h[:-1]
        h = (h + points[n - 1:]) * _ODD[(n - 1) % 3] if n > 1 else points * _ODD[0]
        if n in ORDERS:
            same = doc[:len(h)] == doc[n - 1:]
            bits = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            cells.append((doc[:len(h)] * DIM + ((bits ^ (bits >> np.uint32(13))) & np.uint32(DIM - 1)))[same])
    counts = np.bincount(np.concatenate(cells) if cells else np.zeros(0, np.int64), minlength=1)
    at = np.flatnonzero(counts)
    return at // DIM, at % DIM, counts[at], has


def _weights(doc: np.ndarray, gram: np.ndarray, n: np.ndarray, idf: np.ndarray, docs: int) -> np.ndarray:
    """TF-IDF with sublinear counts, each document of length 1."""
    w = (1 + np.log(n)) * idf[gram]
    norm = np.sqrt(np.bincount(doc, w * w, minlength=docs))
    return w / np.maximum(norm, 1e-12)[doc]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, docs = np.zeros(DIM, np.int64), 0
    for batch in batches:
        for _, texts in _chunks(batch.column("text").to_pylist()):
            doc, gram, _, _ = features(texts)
            df += np.bincount(gram, minlength=DIM)
            docs += len(texts)
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], docs))], names=["gram", "df"])


def idf_of(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of the ``DIM`` n-gram indexes over all of ``docs``."""
    rows = (docs.select("text").mapInArrow(_frequencies, "gram long, df long").groupBy("gram").agg(F.sum("df").alias("df")).collect())
    found = {r["gram"]: r["df"] for r in rows}
    df = np.array([found.get(i, 0) for i in range(DIM)], float)
    return np.log((1 + found.get(-1, 0)) / (1 + df)) + 1


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams, counts, some = [], [], []
        for _, texts in _chunks(batch.column("text").to_pylist()):
            doc, gram, n, has = features(texts)
            cuts = np.searchsorted(doc, np.arange(1, len(texts)))
            grams += np.split(gram.astype(np.int32), cuts)
            counts += np.split(n.astype(np.int32), cuts)
            some += has.tolist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("h"), batch.column("rank"), pa.array(grams, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
            names=["lang", "h", "rank", "grams", "counts"]).filter(pa.array(some, pa.bool_()))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal for softmax regression: (weights DIM x classes, bias).
    ``rows``: (indexes, values, class). L1 keeps rare n-grams at exactly 0."""
    z, n = np.zeros((DIM + 1, classes)), np.zeros((DIM + 1, classes))

    def weight(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        return np.where(np.abs(zi) > L1, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    order = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)):
            at, x, y = rows[k]
            at, x = np.append(at, DIM), np.append(x, 1.0)          # the last one is the bias
            w = weight(at)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weight(np.arange(DIM + 1))
    return w[:DIM], w[DIM]


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss."""
    if not len(y):
        return 1.0
    tried = np.geomspace(0.05, 5, 120)
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in tried]
    return float(tried[int(np.argmin(loss))])


class Model:
    """Names, idf, weights, bias and temperature of a fitted classifier."""

    def __init__(self, names: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, heat: float):
        self.names, self.idf, self.heat = names, idf.astype(np.float32), heat
        self.weights, self.bias = weights.astype(np.float32), bias.astype(np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for _, chunk in _chunks(texts):
            doc, gram, n, has = features(chunk)
            x = _weights(doc, gram, n, self.idf, len(chunk))
            z = np.stack([np.bincount(doc, x * self.weights[gram, c], minlength=len(chunk)) for c in range(len(self.names))], axis=1)
            p = _softmax((z + self.bias) / self.heat)
            best = p.argmax(axis=1)
            names += [self.names[b] if ok else UNKNOWN for b, ok in zip(best, has)]
            scores += np.where(has, p.max(axis=1), 0.0).tolist()
        return names, scores


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE, max_train: int = MAX_TRAIN) -> Model | None:
    """Fit on ``docs`` (doc_id, text, lang); only rows for which ``learn`` holds and
    lang is known are learned from. None if there are none with a letter."""
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = written(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows")), "li-sizes")
    most = max(max_train, LEAST * sizes.count())
    h = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(23)), 11) / F.lit(float(1 << 53))
    # The per-language rate thins every language over its ids to as many rows as any other,
    # and the limit cuts by the place in the language, so it shortens all alike; languages are few.
    sample = (labelled.join(F.broadcast(sizes), "lang").withColumn("h", h)
              .withColumn("rank", F.col("h") * F.col("_rows")).where(F.col("rank") < per_language).select("lang", "h", "rank", "text")
              .mapInArrow(_sparse, "lang string, h double, rank double, grams array<int>, counts array<int>")
              .orderBy("rank", "h", "lang").limit(most).collect())
    sample.sort(key=lambda r: (r["h"], r["lang"].encode()))
    if not sample:
        return None
    idf = idf_of(labelled)
    names = sorted({r["lang"] for r in sample}, key=str.encode)
    rows = []
    for r in sample:
        gram, n = np.array(r["grams"]), np.array(r["counts"])
        rows.append((gram, _weights(np.zeros(len(gram), int), gram, n, idf, 1), names.index(r["lang"])))
    held, kept = rows[::5], [r for i, r in enumerate(rows) if i % 5]
    if len(rows) < 5 * len(names):
        held, kept = [], rows
    learned = {y for *_, y in kept}
    kept = kept + [r for r in held if r[2] not in learned]         # no language is only held out
    w, b = train_ftrl(kept, len(names))
    heat = temperature(np.array([x @ w[g] + b for g, x, _ in held]), np.array([y for *_, y in held], int)) if held else 1.0
    return Model(names, idf, w, b, heat)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (doc_id, text) with lang_pred and score."""
    if model is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
