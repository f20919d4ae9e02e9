"""Exact top-k inner-product search by block-at-a-time pruning.

Vectors become integer term weights, ``floor(64 * x)`` per component. Candidates
are dealt to ranges of about ``RANGE`` rows by width class (so that one long vector widens
no others) and a hash; each range is cut into blocks of ``BLOCK`` vectors that keep, per term, the largest
and the smallest weight and a dense forward index. For a query, the bound of a block is
the sum over terms of weight times that maximum (minimum for negative weights).
Blocks are scored in the order of their bounds until the next bound is below
the k-th score found. Blocks whose bound equals it are still scored: a tie may
have the smaller id.

Queries are a stated subset of the rows. They go to ranges in chunks, in two rounds: first each
query to the range of its best bound, whose k-th score then excludes ranges from the
second round. Each pair of chunk and range is one bounded task; no pair of vectors is ever a row,
and a query becomes a row only for the ranges that it is sent to.

Products of doubles are exact up to 2^53. Rows and queries beyond are scored in doubles with
an error bound first; only rows that the bounds leave near the k-th are scored again in integers
of any size. A few such rows leave the others to the blocks.

Defined cases: null vectors, and vectors holding a null or non-finite component, take
no part; a shorter vector has 0 in its missing components; rows
of one id are searched as separate candidates with equal id, and none is a candidate
for a query of the same id; equal scores order by id; fewer than k candidates give
all; a component whose 64-fold is beyond the doubles is their largest; scores beyond a
long are clipped to its ends; an empty table gives an
empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

K = 20
RANGE = (8192, 65536)      # candidates of a range: a 64th of all, within these bounds
CHUNK = (1024, 8192)       # queries of a chunk, likewise
BLOCK = 64                 # vectors of a block
BOUNDS = 1 << 22           # bounds of queries and ranges held at a time
_MAX = 2**63 - 1
_EXACT = 2.0**53
_WIDE = 2.0**24            # from here on a component's row is kept out of the blocks
_LARGEST = sys.float_info.max


def terms(vector: Column) -> Column:
    """floor(64 * x) per component, or null if any is null or not finite."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    good = vector.isNotNull() & ~F.exists(vector, bad)
    return F.when(good, F.transform(vector, lambda x: F.greatest(
        F.least(F.lit(64.0) * x.cast("double"), F.lit(_LARGEST)), F.lit(-_LARGEST))))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Floor of the rows, 0 beyond a row's end; what is beyond ``width`` is left out."""
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, :min(len(r), width)] = r[:width]
    return np.floor(out, out=out)


class _Range:
    """Blocks of candidates with their term maxima and minima."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        # Alike vectors share blocks, so that the bounds are close: order by the strongest term.
        order = np.lexsort((ids, np.abs(vectors).argmax(axis=1))) if vectors.shape[1] else np.argsort(ids)
        self.ids, self.vectors = ids[order], vectors[order]
        self.cuts = list(range(0, len(ids), BLOCK))
        self.high = np.maximum.reduceat(self.vectors, self.cuts, axis=0)
        self.low = np.minimum.reduceat(self.vectors, self.cuts, axis=0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        if not queries.shape[1]:
            return np.zeros((len(queries), len(self.cuts)))
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query_id: int, query: np.ndarray, bounds: np.ndarray, least: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to k (ids, scores) that can belong to the top k, given that
        ``least`` is a score that k candidates reach elsewhere."""
        order = np.argsort(-bounds, kind="stable")
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 1
        while at < len(order) and bounds[order[at]] >= least:
            some = order[at:at + step]
            some = some[bounds[some] >= least]
            rows = np.concatenate([np.arange(self.cuts[b], min(self.cuts[b] + BLOCK, len(self.ids))) for b in some])
            rows = rows[self.ids[rows] != query_id]
            ids = np.concatenate([ids, self.ids[rows]])
            scores = np.concatenate([scores, self.vectors[rows] @ query])
            if len(ids) > k:
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            if len(ids) == k:
                least = max(least, scores.min())
            at, step = at + len(some) if len(some) == step else len(order), min(step * 2, 64)
        return ids, scores


def _exact(ids: np.ndarray, query: np.ndarray, vectors: np.ndarray) -> list[int]:
    """Scores as integers of any size, clipped to a long."""
    q = [int(x) for x in query]
    return [max(-_MAX, min(_MAX, sum(a * int(b) for a, b in zip(q, v)))) for v in vectors]


def _careful(ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best k (ids, scores) where products may pass 2^53."""
    other = ids != query_id
    ids, vectors = ids[other], vectors[other]
    with np.errstate(over="ignore", invalid="ignore"):
        score = vectors @ query
        # Twice the rounding of a sum of products, in any order.
        slack = (np.abs(vectors) @ np.abs(query)) * (len(query) + 2) * 2.0**-52
        low, high = score - slack, score + slack
    low, high = np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)
    low, high = np.clip(low, -_MAX, _MAX), np.clip(high, -_MAX, _MAX)
    if len(ids) > k:
        near = high >= np.partition(low, -k)[-k]
        ids, vectors, score, slack, low, high = (x[near] for x in (ids, vectors, score, slack, low, high))
    out = np.zeros(len(ids), np.int64)
    out[low >= _MAX], out[high <= -_MAX] = _MAX, -_MAX
    open_ = (low < _MAX) & (high > -_MAX)
    sure = open_ & (slack < 0.5)
    out[sure] = np.rint(score[sure]).astype(np.int64)
    out[open_ & ~sure] = _exact(ids, query, vectors[open_ & ~sure])
    best = np.lexsort((ids, -out))[:k]
    return ids[best], out[best]


def _search(k: int, stated: bool):
    """For one (range, chunk): candidates and queries to the hits of the queries."""

    def run(keys: tuple, candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if candidates.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        width = max(map(len, candidates["v"]))
        ids, rows, qs = candidates["id"].to_numpy(), _matrix(candidates["v"], width), _matrix(queries["v"], width)
        wide = np.abs(rows).max(axis=1, initial=0) >= _WIDE
        rest = None if wide.all() else _Range(ids[~wide], rows[~wide])
        least = queries["least"].to_numpy() if stated else np.full(len(qs), -np.inf)
        with np.errstate(over="ignore", invalid="ignore"):
            blocks = rest is not None and np.abs(qs).sum(axis=1) * np.abs(rest.vectors).max(initial=0) < _EXACT
            bounds = rest.bounds(qs) if rest is not None else None
        found = []
        for i, query_id in enumerate(queries["id"].to_numpy()):
            parts = []
            if rest is not None:
                parts.append(rest.search(query_id, qs[i], bounds[i], least[i], k) if blocks[i] else
                             _careful(rest.ids, rest.vectors, query_id, qs[i], k))
            if wide.any():
                parts.append(_careful(ids[wide], rows[wide], query_id, qs[i], k))
            found.append((np.concatenate([p[0] for p in parts]), np.concatenate([p[1].astype(np.int64) for p in parts])))
        return pd.DataFrame({
            "query_id": np.repeat(queries["id"].to_numpy(), [len(i) for i, _ in found]),
            "vec_id": np.concatenate([i for i, _ in found]), "score": np.concatenate([s for _, s in found])})

    return run


def _extremes(group: pd.DataFrame) -> pd.DataFrame:
    width = max(map(len, group["v"]))
    m = _matrix(group["v"], width)
    return pd.DataFrame({"range": [group["range"].iloc[0]], "high": [m.max(axis=0).tolist()], "low": [m.min(axis=0).tolist()]})


class _Ends:
    """Largest and smallest term of every range."""

    def __init__(self, ranges: list[tuple[int, np.ndarray, np.ndarray]]):
        self.width = max(len(h) for _, h, _ in ranges)
        self.names = np.array([r for r, _, _ in ranges])
        self.high, self.low = np.zeros((len(ranges), self.width)), np.zeros((len(ranges), self.width))
        for i, (_, h, l) in enumerate(ranges):            # a shorter vector has 0s
            self.high[i, :len(h)], self.low[i, :len(l)] = np.maximum(h, 0), np.minimum(l, 0)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """No score of query and range is above; a row a query."""
        size = np.maximum(self.high, -self.low)
        with np.errstate(over="ignore", invalid="ignore"):
            out = np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T
            if not np.abs(q).sum(axis=1).max(initial=0) * size.max(initial=0) < _EXACT:
                out = out + np.abs(q) @ size.T * (self.width + 2) * 2.0**-52
        return np.maximum(np.where(np.isnan(out), np.inf, out), -_MAX)

    def pieces(self, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
        step = max(1, BOUNDS // len(self.names))
        for batch in batches:
            for at in range(0, len(batch), step):
                piece = batch.iloc[at:at + step]
                yield piece, self.bounds(_matrix(piece["v"], self.width))

    def home(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Queries with the range of their best bound."""
        for piece, bounds in self.pieces(batches):
            yield piece.assign(range=self.names[bounds.argmax(axis=1)])

    def others(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Queries, once for every range but home that may hold one of their best."""
        for piece, bounds in self.pieces(batches):
            row, at = np.nonzero((bounds >= piece["least"].to_numpy()[:, None]) & (piece["range"].to_numpy()[:, None] != self.names))
            for a in range(0, len(row), self.most):
                yield piece.iloc[row[a:a + self.most]].assign(range=self.names[at[a:a + self.most]])

    #: Rows of a batch that ``others`` sends.
    most = 4096


def search(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row for which ``is_query``
    holds, its ``k`` best rows by integer inner product, itself left out."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), terms(F.col(vector_col)).alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("is_query")).where("v is not null and id is not null")
    rows = written(rows, "topk-rows")
    total = rows.count()
    n_ranges, n_chunks = (max(1, -(-n // min(high, max(low, n // 64)))) for n, (low, high) in
                          ((total, RANGE), (rows.where("is_query").count(), CHUNK)))
    widths = F.floor(F.log2(F.size("v") + 1)).cast("int")
    placed = rows.select("id", "v", (widths * n_ranges + F.pmod(F.xxhash64("id", "v"), F.lit(n_ranges))).cast("int").alias("range"))
    queries = rows.where("is_query").select(F.col("id").alias("id"), F.col("v").alias("v"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_chunks)).cast("int").alias("chunk"))
    hits = "query_id long, vec_id long, score long"
    if total == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def searched(dealt: DataFrame, stated: bool) -> DataFrame:
        # Candidates go once to every chunk that reaches their range.
        pairs = dealt.select(F.col("range").alias("range"), F.col("chunk").alias("chunk")).distinct()
        sent = placed.join(pairs, "range")
        return (sent.groupBy("range", "chunk").cogroup(dealt.groupBy("range", "chunk"))
                .applyInPandas(lambda key, a, b: _search(k, stated)(key, a, b), hits))

    # One row of 2 x width numbers a range: against thousands of vectors in each.
    ends = _Ends([(r["range"], np.array(r["high"]), np.array(r["low"])) for r in
                  placed.groupBy("range").applyInPandas(_extremes, "range int, high array<double>, low array<double>").collect()])
    if len(ends.names) == 1:
        best = searched(queries.withColumns({"range": F.lit(int(ends.names[0])), "least": F.lit(0.0)}), False)
    else:
        schema = T.StructType([*queries.schema.fields, T.StructField("range", T.IntegerType()), T.StructField("least", T.DoubleType())])
        none = F.lit(float("-inf"))
        home = written(queries.withColumns({"range": F.lit(0), "least": none}).mapInPandas(ends.home, schema), "topk-home")
        first = written(searched(home, False), "topk-first")
        kth = (first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("score"), False).alias("scores"))
               .select(F.col("query_id").alias("id"), F.when(F.col("n") >= k, F.get("scores", F.lit(k - 1)).cast("double")).otherwise(none).alias("least")))
        others = home.drop("least").join(kth, "id", "left").withColumn("least", F.coalesce("least", none)).select(*schema.names)
        best = first.unionByName(searched(others.mapInPandas(ends.others, schema), True))
    # Each range sends at most k rows a query; hits are gathered per query and cut to k.
    top = best.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("top"))
    return top.select("query_id", F.posexplode("top")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id").alias("vec_id"), (-F.col("col.s")).alias("score"))
