"""Importance resampling towards a target: documents that look like the target texts
are drawn more often.

1. Hashed runs of words are counted into ``BUCKETS`` buckets over all documents and over
   all target texts; each task sends one count a bucket.
2. A bucket's gain is the log ratio of its smoothed shares; the array of gains
   (``BUCKETS`` integers) scores every document: its weight is the sum over its runs.
3. Weight plus Gumbel noise, made from a hash of the id, is the score: the highest
   scores are a sample without replacement in proportion to the weights.
4. The k-th highest (score, id, number of runs) is found by distributed quickselect: random
   rows of the range that is left are the pivots, one aggregate counts the rows between
   and on them exactly, and the range shrinks to the gap or the pivot that holds the
   k-th. No row is sorted for it, and no more than ``PIVOTS`` keys and their counts reach the
   driver.
5. Only the winners are sorted, by ranges, with rows alike counted first, so a key that
   many rows share is one row of the sort.

Words are runs of digits, a-z (A-Z lower-cased) and all code points from U+0080 on.

Defined cases: null texts have no words, weight 0 and are never drawn; rows without
``doc_id`` have a weight but no score, are not counted in N and not drawn; ties go to the
smaller id, then to fewer runs; rows alike in all of that are dealt ranks one after the
other, and which of them gets none does not show; repeated rows count each; an empty
target gives every bucket the gain of an unseen one; other columns are ignored; empty
tables give empty results.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, written

BUCKETS = 10_000
ORDERS = 1
LEAST_WORDS, SHARE_PERCENT = 20, 10
SEED = 2024
PIVOTS = 24
#: Longer words are hashed one by one.
LONG_WORD = 64

_WORD = np.zeros(256, bool)
_WORD[ord("0"):ord("9") + 1] = _WORD[ord("A"):ord("Z") + 1] = _WORD[ord("a"):ord("z") + 1] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _crc_table() -> np.ndarray:
    rest = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rest = np.where(rest & np.uint32(1), (rest >> np.uint32(1)) ^ np.uint32(0xEDB88320), rest >> np.uint32(1))
    return rest


_CRC = _crc_table()


def word_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and per text the index of its first word."""
    word = _WORD[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = word[1:] != word[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    some = word[starts] if len(starts) else np.zeros(0, bool)
    return starts[some], ends[some], np.searchsorted(starts[some], offsets)


def crc_on(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of many byte strings at once, each carried on from ``state``."""
    crc = ~state
    size = ends - starts
    long = size > LONG_WORD
    left = np.flatnonzero(~long)
    for i in range(LONG_WORD):
        left = left[size[left] > i]
        if not len(left):
            break
        crc[left] = _CRC[(crc[left] ^ data[starts[left] + i]) & np.uint32(255)] ^ (crc[left] >> np.uint32(8))
    crc = ~crc
    for i in np.flatnonzero(long).tolist():
        crc[i] = zlib.crc32(data[starts[i]:ends[i]], int(state[i]))
    return crc


def features(data: np.ndarray, offsets: np.ndarray, orders: int = ORDERS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of every run of 1 to ``orders`` words, and the words of each text."""
    data = _LOWER[data]
    starts, ends, first = word_runs(data, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    state = crc_on(np.zeros(len(starts), np.uint32), data, starts, ends)
    texts, found = [text], [state % np.uint32(buckets)]
    space = np.full(1, 32, np.uint8)
    for n in range(2, orders + 1):
        if len(text) < n:
            break
        state = crc_on(state[:-1], space, np.zeros(len(state) - 1, np.int64), np.ones(len(state) - 1, np.int64))
        state = crc_on(state, data, starts[n - 1:], ends[n - 1:])
        same = text[:len(state)] == text[n - 1:]
        texts.append(text[:len(state)][same])
        found.append((state % np.uint32(buckets))[same])
    return np.concatenate(texts), np.concatenate(found).astype(np.int64), np.diff(first)


def bucket_counts(texts: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all of ``texts`` (text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column("text")):
                total += np.bincount(features(data, offsets, orders, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    n, all_raw, all_target = len(raw), int(raw.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float((t + 1) * (all_raw + n)) / float((s + 1) * (all_target + n))))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, orders: int = ORDERS) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                text, bucket, words = features(data, offsets, orders, len(gain))
                # Whole numbers below 2^53 in size, so the sums in doubles are exact.
                weight = np.bincount(text, gain[bucket], minlength=b - a).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], pa.array(words), pa.array(np.bincount(text, minlength=b - a)), pa.array(weight)],
                                                 names=["doc_id", "n_words", "n_features", "weight"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(seed: int = SEED) -> Column:
    """Thousandths of the noise that the id's hash stands for, rounded down."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


#: The order of the draw: score downwards, then id and number of runs upwards.
KEY = ("score", "doc_id", "n_features")


def _before(key: dict) -> Column:
    """Rows that come before ``key``."""
    score, doc, n = (F.lit(key[k]) for k in KEY)
    return (F.col("score") > score) | ((F.col("score") == score) & ((F.col("doc_id") < doc) | ((F.col("doc_id") == doc) & (F.col("n_features") < n))))


def _equal(key: dict) -> Column:
    return (F.col("score") == F.lit(key["score"])) & (F.col("doc_id") == F.lit(key["doc_id"])) & (F.col("n_features") == F.lit(key["n_features"]))


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS) -> tuple[dict, int]:
    """The k-th key of ``rows`` (from 1, at most their number) in the order of the
    draw, and how many rows come before it. ``rows`` is read twice a round."""
    low = high = None                  # the k-th lies strictly between them
    done = 0                           # rows up to and with ``low``
    turn = 0
    while True:
        left = rows
        if low is not None:
            left = left.where(~_before(low) & ~_equal(low))
        if high is not None:
            left = left.where(_before(high))
        # Random rows: as many as pivots, and the same in a rerun.
        drawn = left.orderBy(F.xxhash64(F.lit(turn), *KEY), *KEY).limit(pivots).select(*KEY).collect()
        keys = sorted({tuple(r[c] for c in KEY) for r in drawn}, key=lambda t: (-t[0], t[1], t[2]))
        keys = [dict(zip(KEY, t)) for t in keys]
        # Place 2i: in the gap before pivot i; 2i + 1: on it; the last: after all.
        place = F.lit(2 * len(keys))
        for i in reversed(range(len(keys))):
            place = F.when(_before(keys[i]), 2 * i).when(_equal(keys[i]), 2 * i + 1).otherwise(place)
        counted = dict(left.groupBy(place.alias("place")).count().collect())
        for i in range(2 * len(keys) + 1):
            n = counted.get(i, 0)
            if done + n >= k:
                break
            done += n
        if i % 2:
            return keys[i // 2], done
        low, high, turn = keys[i // 2 - 1] if i else low, keys[i // 2] if i < 2 * len(keys) else high, turn + 1


def draw(scored: DataFrame, percent: int = SHARE_PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` (doc_id, n_words, n_features, weight, score) with rank: the place of
    the drawn rows, null for the others. ``scored`` is read several times."""
    able = scored.where((F.col("n_words") >= least_words) & F.col("doc_id").isNotNull())
    k = percent * able.count() // 100
    cols = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*cols, none)
    key, ahead = kth_key(able, k)
    could = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    won = could & (_before(key) | _equal(key))
    lost = scored.where(~F.coalesce(won, F.lit(False))).select(*cols, none)
    # Rows alike are one row with their number; those of the k-th key may get fewer ranks than rows.
    alike = scored.where(won).groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("n_features").asc(), F.col("weight").asc()]
    ranges = alike.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ranges = written(ranges, "ir-winners")
    sizes = {r["range"]: r["n"] for r in ranges.groupBy("range").agg(F.sum("copies").alias("n")).collect()}
    starts = [(part, sum(n for other, n in sizes.items() if other < part)) for part in sorted(sizes)]
    # One row a range.
    starts = scored.sparkSession.createDataFrame(starts, "range int, start long")
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("start") + F.coalesce(F.sum("copies").over(inside), F.lit(0))
    each = ranges.join(F.broadcast(starts), "range").select(*cols, "copies", first.alias("first")).select(*cols, F.col("first"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("i"))
    place = (F.col("first") + F.col("i")).cast("long")
    return lost.unionByName(each.select(*cols, F.when(place <= k, place).alias("rank")))


def resample(docs: DataFrame, target: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS, percent: int = SHARE_PERCENT,
             least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs`` (doc_id,
    text), drawn towards ``target`` (text)."""
    gain = gains(bucket_counts(docs, orders, buckets), bucket_counts(target, orders, buckets))
    scored = written(weighed(docs, gain, orders).withColumn("score", F.col("weight") + gumbel(seed)), "ir-scored")
    return draw(scored, percent, least_words)
