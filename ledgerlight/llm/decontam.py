"""Benchmark decontamination: BM25 with block-max pruning, then overlap of
question and answer.

Test items (in segments of at most ``SEGMENT`` words) form an inverted index: per
term its postings with BM25 impacts, divided by the segment's own score, so a
passage that holds a whole segment scores 1. Postings are grouped into blocks of
``BLOCK`` segments with each term's largest impact in the block. Every passage of
every document (``UNIT`` x 2 words, one unit overlapping the next) is a query:

1. WAND bound: the sum of its terms' largest impacts must reach the threshold;
2. block-max bound: the same sum within a block of segments;
3. segments of the blocks that are left are scored exactly.

All pairs of passage and segment at or above ``THRESHOLD`` are kept and verified:
the word 3-grams of the question and the words of the answer (the item's last
sentence) must occur in the passage.

Document frequencies of terms are those of the whole benchmark. The index is
broadcast in shards of at most about ``MAX_POSTINGS`` postings; a larger benchmark takes
more scans, with the same result. Documents are not shuffled.

Words are compared without regard to case, by Unicode (upper-cased, then
case-folded: ``ß`` is ``SS``, ``É`` is ``é``), and without the punctuation, symbols and
Unicode spaces at their edges (a word of nothing else stays); accents count. op9's
contract (A-Z only, punctuation kept) holds for op9 alone.

Defined cases: null or blank texts hold nothing; items without words match
nothing; repeated items count once, different texts of one id are parts of one item; repeated documents are judged row by row; an item of
one sentence is all question; empty tables give empty results.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shingle_hashes, slices, word_hashes, word_spans, written

SEGMENT = 48
UNIT = 48
BLOCK = 8
THRESHOLD = 0.65
QUESTION, ANSWER = 0.5, 0.5
GRAM = 3
K1, B = 1.2, 0.75
MAX_POSTINGS = 1_000_000
CHUNK_UNITS = 1024
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


@lru_cache
def _edges() -> str:
    """Punctuation, symbols and Unicode spaces."""
    return "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c)[0] in "PSZ")


def _trim(word: str) -> str:
    return word if word[0].isalnum() and word[-1].isalnum() else word.strip(_edges()) or word


def fold(text: bytes) -> bytes:
    """UTF-8 with as many words, in one case and without punctuation at their edges."""
    chars = text.decode("utf-8", "surrogateescape")
    chars = chars.lower() if text.isascii() else chars.upper().casefold()
    return " ".join(map(_trim, _WORD.findall(chars))).encode("utf-8", "surrogateescape")


_EDGE = np.zeros(256, bool)
_EDGE[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def folded_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word as ``fold`` leaves it, and per text the index of its first
    word. ASCII and the letters U+00C0 to U+00FF but for U+00DF are folded and trimmed as
    bytes; each other distinct word goes through ``fold`` once."""
    starts, ends, first = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    # The letters with two bytes, of which the first is C3; 97 and B7 are the signs for times and divided, 9F has no single capital.
    lead = data == 0xC3
    after = np.zeros(len(data), bool)
    after[1:] = lead[:-1]
    plain = after & (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0x9F) & (data != 0xB7)
    other = (data >= 0x80) & ~lead & ~plain
    other[:-1] |= lead[:-1] & ~plain[1:]
    other[-1] |= lead[-1]
    before = np.zeros(len(data) + 1, np.int32)
    np.cumsum(other, out=before[1:])
    odd = before[ends] > before[starts]
    lower = data + np.where(plain & (data <= 0x9E), np.uint8(0x20), np.uint8(0))
    # Without the punctuation at its edges, unless it is nothing else.
    solid = ~_EDGE[data]
    np.cumsum(solid, out=before[1:])
    at = np.append(np.flatnonzero(solid), 0)
    some = before[ends] > before[starts]
    a, b = np.where(some, at[before[starts]], starts), np.where(some, at[before[ends] - 1] + 1, ends)
    out = word_hashes(lower, a, b)
    if odd.any():
        at = np.flatnonzero(odd)
        _, one, which = np.unique(word_hashes(data, starts[at], ends[at]), return_index=True, return_inverse=True)
        words = [fold(data[x:y].tobytes()) for x, y in zip(starts[at[one]].tolist(), ends[at[one]].tolist())]
        stops = np.cumsum([len(w) for w in words])
        out[at] = word_hashes(np.frombuffer(b"".join(words), np.uint8), np.append(0, stops[:-1]), stops)[which]
    return out, first


def hashed_words(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return folded_words(data, np.array([0, len(data)]))[0]


def split_item(text: str | None) -> tuple[str, str]:
    """Question and answer: the last sentence answers, if there are several."""
    sentences = [s for s in re.split(r"(?<=[.?!])\s+", (text or "").strip()) if s]
    return (" ".join(sentences[:-1]), sentences[-1]) if len(sentences) > 1 else (" ".join(sentences), "")


def segments(item_id: int, text: str | None) -> Iterator[tuple[int, int, list[int], int]]:
    """(item, segment, word hashes as longs, words of them that belong to the question)."""
    question, answer = (hashed_words(x) for x in split_item(text))
    words = np.concatenate([question, answer])
    n = -(-len(words) // SEGMENT)
    for i in range(n):
        a, b = i * len(words) // n, (i + 1) * len(words) // n
        yield item_id, i, words[a:b].astype(np.int64).tolist(), int(min(max(len(question) - a, 0), b - a))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [s for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()) if item is not None
                for s in segments(item, text)]
        yield pa.RecordBatch.from_pydict({"item_id": pa.array([r[0] for r in rows], pa.int64()), "segment": pa.array([r[1] for r in rows], pa.int32()),
                                          "words": pa.array([r[2] for r in rows], pa.list_(pa.int64())), "question": pa.array([r[3] for r in rows], pa.int32())})


class Index:
    """Inverted index of segments with block maxima.

    ``rows``: (item, words, question words, document frequency by word)."""

    def __init__(self, rows: list[tuple[int, list[int], int, list[int]]], total: int, mean: float):
        self.items = np.array([r[0] for r in rows], np.int64)
        self.questions, self.answers = [], []
        term_of: dict[int, int] = {}
        at, seg, impact = [], [], []
        for i, (_, words, question, df) in enumerate(rows):
            w = np.array(words, np.int64).view(np.uint64)
            self.questions.append((min(GRAM, question), np.unique(shingle_hashes(w[:question], GRAM))))
            self.answers.append(np.unique(w[question:]))
            counts: dict[int, int] = defaultdict(int)
            dfs = {}
            for word, f in zip(words, df):
                counts[word] += 1
                dfs[word] = f
            norm = K1 * (1 - B + B * len(words) / mean)
            own = {t: np.log(1 + (total - dfs[t] + 0.5) / (dfs[t] + 0.5)) * n * (K1 + 1) / (n + norm) for t, n in counts.items()}
            score = sum(own.values())
            for t, value in own.items():
                at.append(term_of.setdefault(t, len(term_of)))
                seg.append(i)
                impact.append(value / score)
        names = np.array(list(term_of), np.int64).view(np.uint64)
        order = np.argsort(names)
        self.terms = names[order]                                     # sorted hashes
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at, seg, impact = place[np.array(at, np.int64)], np.array(seg, np.int64), np.array(impact)
        by = np.lexsort((seg, at))
        self.seg, self.impact = seg[by], impact[by]
        self.first = np.searchsorted(at[by], np.arange(len(names) + 1))
        # Per term the largest impact of all, and a list of (block, largest impact in it).
        self.upper = np.zeros(len(names))
        np.maximum.at(self.upper, at, impact)
        key = at[by] * (len(rows) // BLOCK + 1) + self.seg // BLOCK
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        self.block = (self.seg // BLOCK)[cut]
        self.block_max = np.maximum.reduceat(self.impact, cut) if len(cut) else np.zeros(0)
        self.block_first = np.searchsorted(at[by][cut], np.arange(len(names) + 1))
        self.n_blocks = len(rows) // BLOCK + 1

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words that are terms, and their terms."""
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == words)
        return hit, at[hit]

    @staticmethod
    def _lists(first: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of all list entries of ``terms``, and which term each belongs to."""
        size = first[terms + 1] - first[terms]
        owner = np.repeat(np.arange(len(terms)), size)
        return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + first[terms][owner], owner

    def search(self, passage: np.ndarray, term: np.ndarray, n: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, segment, score) at or above ``threshold``. ``passage`` and
        ``term``: the distinct terms of each of ``n`` passages."""
        slack = threshold - 1e-9
        bound = np.bincount(passage, self.upper[term], minlength=n)
        keep = bound[passage] >= slack                                # WAND bound
        passage, term = passage[keep], term[keep]
        entry, owner = self._lists(self.block_first, term)
        cell = passage[owner] * self.n_blocks + self.block[entry]
        blocks = np.bincount(cell, self.block_max[entry], minlength=n * self.n_blocks)
        alive = blocks >= slack                                       # block-max bound
        some = alive.reshape(n, self.n_blocks).any(axis=1)[passage]
        passage, term = passage[some], term[some]
        entry, owner = self._lists(self.first, term)
        seg, row = self.seg[entry], passage[owner]
        keep = alive[row * self.n_blocks + seg // BLOCK]
        seg, row, value = seg[keep], row[keep], self.impact[entry[keep]]
        pairs, inverse = np.unique(row * len(self.items) + seg, return_inverse=True)
        score = np.bincount(inverse, value, minlength=len(pairs))
        good = score >= slack
        return pairs[good] // len(self.items), pairs[good] % len(self.items), score[good]

    def verify(self, seg: int, words: np.ndarray) -> tuple[float, float]:
        """Share of the question's 3-grams and of the answer's words in the passage;
        1 for a part that the segment does not have."""
        (gram, question), answer = self.questions[seg], self.answers[seg]
        q = np.isin(question, shingle_hashes(words, gram)).mean() if len(question) else 1.0
        a = np.isin(answer, words).mean() if len(answer) else 1.0
        return float(q), float(a)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], tuple[float, float, float, int]]:
        """(text, item) to (score, question overlap, answer overlap, first word of
        the passage), the best passage of each pair."""
        words, first = folded_words(data, offsets)
        size = np.diff(first)
        # Units of UNIT words per text; a passage is a unit and the next one of its text.
        units = np.maximum(-(-size // UNIT), 0)
        unit_first = np.r_[0, np.cumsum(units)]
        unit_doc = np.repeat(np.arange(len(size)), units)
        hit, term = self.find(words) if len(self.terms) and len(words) else (np.zeros(0, np.int64),) * 2
        doc = np.searchsorted(first, hit, "right") - 1
        unit = unit_first[doc] + (hit - first[doc]) // UNIT
        found: dict[tuple[int, int], tuple[float, float, float, int]] = {}
        for a in range(0, len(unit_doc), CHUNK_UNITS):
            lo, hi = np.searchsorted(unit, [a, a + CHUNK_UNITS + 1])
            u, t = unit[lo:hi], term[lo:hi]
            before = (u > a) & (unit_doc[u] == unit_doc[np.maximum(u - 1, 0)])          # the unit before takes these words too
            own = u < a + CHUNK_UNITS
            cells = np.unique(np.concatenate([(u[own] - a) * len(self.terms) + t[own], (u[before] - 1 - a) * len(self.terms) + t[before]]))
            rows, segs, scores = self.search(cells // len(self.terms), cells % len(self.terms), CHUNK_UNITS, self.threshold)
            for row, seg, score in zip((rows + a).tolist(), segs.tolist(), scores.tolist()):
                d = int(unit_doc[row])
                at = int(first[d]) + (row - int(unit_first[d])) * UNIT
                q, ans = self.verify(seg, words[at:min(at + 2 * UNIT, int(first[d + 1]))])
                key = (d, int(self.items[seg]))
                if q >= self.question and ans >= self.answer and (key not in found or score > found[key][0] + 1e-12):
                    found[key] = (score, q, ans, at - int(first[d]))
        return found

    threshold, question, answer = THRESHOLD, QUESTION, ANSWER


def build(items: DataFrame, max_postings: int = MAX_POSTINGS) -> Iterator[Index]:
    """Index shards of ``items`` (item_id, text)."""
    cut = written(items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        _segments, "item_id long, segment int, words array<long>, question int").distinct()
        .withColumn("text", F.xxhash64("words")), "dc-segments")
    row = cut.agg(F.count(F.lit(1)), F.avg(F.size("words")), F.sum(F.size("words"))).first()
    if not row[0]:
        return
    frequency = written(cut.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df")), "dc-df")
    each = cut.select("item_id", "segment", "text", "question", F.posexplode("words").alias("pos", "word")).join(frequency, "word")
    shards = max(1, -(-row[2] // max_postings))
    for shard in range(shards):
        mine = each.where(F.pmod(F.xxhash64("item_id", "segment"), F.lit(shards)) == shard)
        # About ``max_postings`` words of the benchmark.
        rows = (mine.groupBy("item_id", "segment", "text", "question").agg(F.sort_array(F.collect_list(F.struct("pos", "word", "df"))).alias("w"))
                .orderBy("item_id", "segment", "text").collect())
        if rows:
            yield Index([(r["item_id"], [x["word"] for x in r["w"]], r["question"], [x["df"] for x in r["w"]]) for r in rows], row[0], row[1])


_HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


def contaminated(docs: DataFrame, items: DataFrame, max_postings: int = MAX_POSTINGS) -> DataFrame:
    """One row per (document, item) found: its best passage's score, overlaps and
    first word."""
    out = None
    for index in build(items, max_postings):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, rows = batch.column("doc_id").to_pylist(), []
                for a, _, data, offsets in slices(batch.column("text")):
                    rows += [(ids[a + d], item, *found) for (d, item), found in sorted(shared.value.matches(data, offsets).items())]
                yield pa.RecordBatch.from_pydict({
                    n: pa.array([r[i] for r in rows], pa.float64() if 2 <= i < 5 else pa.int64())
                    for i, n in enumerate(("doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"))})

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _HITS)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], _HITS)
    # Segments of an item can lie in different shards.
    best = F.max(F.struct("score", "question_overlap", "answer_overlap", (-F.col("first_word")).alias("at")))
    return out.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", F.round("b.score", 6).alias("score"), "b.question_overlap", "b.answer_overlap", (-F.col("b.at")).alias("first_word"))


def clean(docs: DataFrame, items: DataFrame, max_postings: int = MAX_POSTINGS) -> DataFrame:
    """``docs`` without the documents that hold a test item; no shuffle."""
    kind = docs.schema
    for index in build(items, max_postings):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for a, _, data, offsets in slices(batch.column("text")):
                    for d, _item in shared.value.matches(data, offsets):
                        keep[a + d] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, kind)
    return docs
