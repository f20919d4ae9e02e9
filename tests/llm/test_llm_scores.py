"""Context-tree scores, importance resampling and fill-in-the-middle against brute force."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import context_tree, importance, infill
from ledgerlight.llm.common import slices

ODD = [None, "", " ", "\n", "a", "<P>", "x<M>y", "Ünï cödé 東京 😀 mixed-Case  words", "A" * 5000, "tail <", "é", "aé", "éa", "a\u0301b", "1234567", "12345678", "abcdefgh" * 4]


# --- context trees ----------------------------------------------------------------

def lower(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


class Tree:
    """One binary decision's context tree, by recursion over all its contexts."""

    def __init__(self, depth):
        self.depth, self.counts = depth, {}

    def add(self, context, bit):
        for d in range(self.depth + 1):
            self.counts.setdefault(context[:d], [0, 0])[bit] += 1

    def weigh(self):
        self.own, self.weighted = {}, {}
        inner = Counter()
        for c in sorted(self.counts, key=len, reverse=True):
            zeros, ones = self.counts[c]
            own = math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)
            w = own if len(c) == self.depth else math.log(0.5 * math.exp(own) + 0.5 * math.exp(inner[c]))
            self.own[c], self.weighted[c] = own, w
            if c:
                inner[c[:-1]] += w

    def probability(self, context, bit):
        if () not in self.counts:
            return 0.5
        d = max(k for k in range(self.depth + 1) if context[:k] in self.counts)
        p = None
        for k in range(d, -1, -1):
            c = context[:k]
            estimate = (self.counts[c][bit] + 0.5) / (sum(self.counts[c]) + 1)
            share = 1.0 if k == self.depth else math.exp(self.own[c] + math.log(0.5) - self.weighted[c])
            p = estimate if p is None else share * estimate + (1 - share) * p
        return p


def bits_of(text, depth):
    data = [255] * depth + list(lower(text)) + [255]
    for i in range(depth, len(data)):
        context = tuple(reversed(data[i - depth:i]))
        for k in range(8):
            yield (k, data[i] >> (8 - k)), context, data[i] >> (7 - k) & 1


def brute_scores(rows, learned, depth):
    trees = {}
    for i, text in rows:
        if learned(i):
            for node, context, bit in bits_of(text, depth):
                trees.setdefault(node, Tree(depth)).add(context, bit)
    for tree in trees.values():
        tree.weigh()
    none = Tree(depth)
    return [sum(math.log10(trees.get(node, none).probability(context, bit)) for node, context, bit in bits_of(text, depth)) for _, text in rows]


@pytest.mark.parametrize("depth,near,block", [(5, 3, 64 << 20), (3, 3, 300), (4, 3, 1), (6, 4, 64 << 20)])
def test_context_tree_against_brute_force(spark, depth, near, block, monkeypatch):
    rng = random.Random(depth)
    texts = ODD[:8] + [" ".join(rng.choice(["the", "of", "Tho", "tion", "ère", "x"]) for _ in range(rng.randint(1, 12))) for _ in range(24)]
    rows = list(enumerate(texts)) + [(3, "again the"), (3, "again the"), (None, "no id"), (7, None)]
    monkeypatch.setattr(context_tree, "BLOCK_BYTES", block)
    monkeypatch.setattr(context_tree, "GROUP_ROWS", 50)
    learned = lambda i: i is not None and i % 3 != 1
    docs = spark.createDataFrame([(i, t, 0, "k") for i, t in rows], "doc_id long, text string, block int, key string").repartition(3)
    got = context_tree.score_documents(docs, F.col("doc_id") % 3 != 1, depth, near).collect()
    tokens = [re.findall(rb"[^\x20\x09-\x0D]+", lower(t)) + [b"</s>"] for _, t in rows]
    counts = Counter(w for (i, _), ws in zip(rows, tokens) if learned(i) for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    want = [(i, len(ws), sum(counts[w] > 0 for w in ws), total,
             round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws), 6), round(s, 6))
            for (i, _), ws, s in zip(rows, tokens, brute_scores(rows, learned, depth))]
    have = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)


def test_context_tree_blocks_go_to_python_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(context_tree, "PACK_BYTES", 1000)
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(100))) for i in range(60)], "doc_id long, text string").coalesce(1)
    scored = context_tree.score_documents(docs, F.lit(True))
    assert "FlatMapCoGroups" not in scored._jdf.queryExecution().executedPlan().toString()      # a group is one buffer there
    blocks, _ = context_tree.in_blocks(docs, F.lit(True), context_tree.DEPTH)
    strings = blocks.select("block", "pack").mapInArrow(context_tree._strings(context_tree.DEPTH), "block long, key long, n long")
    rows = sorted([(r.key, 1) for r in blocks.collect()] + [(r.key, 0) for r in strings.collect()])
    packs = [pack for _, pack in rows]
    assert sum(packs) == 60 and max(sum(packs[i:i + 1000]) for i in range(0, len(packs), 1000)) < 20


def test_context_tree_scoring_holds_a_blocks_strings_once():
    texts, keys, rows = ["ab abc", "", "zz"], [], 1 << 19
    table = pa.table({"doc_id": [1, 2, 3], "text": texts})
    for _, _, data, offsets in slices(table.column("text")):
        keys += [*context_tree.string_keys(data, offsets)[0].tolist(), *context_tree.word_keys(data, offsets)[0].tolist()]
    places = np.unique(np.concatenate([np.arange(rows - len(keys)), keys]))
    pack = context_tree._packed(table.combine_chunks().to_batches()[0])

    def batches():
        for block in (1, 2):
            for a in range(0, len(places), 10_000):
                key = places[a:a + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key) + 1, block)), pa.array(np.append(key, key[-1])),
                                                  pa.array([float(block)] * len(key) + [None]), pa.array([None] * len(key) + [pack if a == 20_000 else b""], pa.binary(), mask=np.array([True] * len(key) + [a != 20_000]))],
                                                 names=["block", "key", "value", "pack"])

    tracemalloc.start()
    got = pa.Table.from_batches(context_tree._score(5, 9, 3, 4)(batches())).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r["doc_id"], r["n_tokens"], r["n_known"], r["score"]) for r in got] == [
        (i, n, n, block * (len(t) + 1.0)) for block in (1, 2) for i, n, t in zip((1, 2, 3), (3, 1, 2), texts)]
    assert peak < 32 * rows                            # key and value are 16 bytes a row


def test_context_tree_without_learned_or_any_texts(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in context_tree.score_documents(docs, F.lit(None).cast("boolean")).collect()}
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens) == (2, 0, 0)
    assert abs(got[1].score - 24 * math.log10(0.5)) < 1e-9 and abs(got[2].score - 8 * math.log10(0.5)) < 1e-9
    assert got[1].base_score == 0                      # 0.5 / 0.5 for every token
    assert context_tree.score_documents(docs.limit(0), F.lit(True)).count() == 0


def test_kt_estimates():
    n = np.array([0, 1, 2, 5, 4096, 4097, 10 ** 6])
    for a in n:
        want = [math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi) for b in n.tolist()]
        assert np.allclose(context_tree.log_kt(np.full(len(n), a), n), want, rtol=1e-12, atol=1e-8)


# --- importance resampling --------------------------------------------------------

def brute_weights(rows, target, orders, buckets):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t).decode())
    runs = lambda t: [" ".join(words(t)[i:i + n]) for n in range(1, orders + 1) for i in range(len(words(t)) - n + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in runs(t))
    t = Counter(bucket(f) for x in target for f in runs(x))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets))))
    return [(len(words(x)), len(runs(x)), sum(gain(bucket(f)) for f in runs(x))) for _, x in rows]


def noise(i, seed):
    h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


@pytest.mark.parametrize("orders,buckets,percent,least", [(1, 10_000, 10, 3), (2, 97, 50, 1), (3, 7, 100, 0)])
def test_resampling_against_brute_force(spark, orders, buckets, percent, least):
    rng = random.Random(orders)
    words = ["Alpha", "beta", "東京", "éa", "x1", "-", "<p>", "w" * 90]
    rows = [(rng.randrange(10 ** 6), " ".join(rng.choice(words) for _ in range(rng.randint(0, 9)))) for _ in range(150)]
    rows += [(-5, t) for t in ODD] + [(77, "beta beta beta")] * 9 + [(None, "alpha beta x1 x1")]
    target = ["alpha alpha beta", None, "", "東京 x1"]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, score int, rank int").repartition(4)
    got = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), orders, buckets, percent, least).collect()
    base = [(i, w, n, g, None if i is None else g + noise(i, 2024)) for (i, _), (w, n, g) in zip(rows, brute_weights(rows, target, orders, buckets))]
    able = sorted((r for r in base if r[1] >= least and r[0] is not None), key=lambda r: (-r[4], r[0], r[2], r[3]))
    k = percent * len(able) // 100
    want = [(i, n, g, s, place + 1 if place < k else None) for place, (i, _, n, g, s) in enumerate(able)]
    want += [(i, n, g, s, None) for i, w, n, g, s in base if w < least or i is None]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_quickselect_finds_every_place(spark):
    rng = random.Random(1)
    keys = [(rng.randrange(5), rng.randrange(4), rng.randrange(2)) for _ in range(60)]
    rows = spark.createDataFrame(keys, "score long, doc_id long, n_features long").cache()
    ordered = sorted(keys, key=lambda t: (-t[0], t[1], t[2]))
    for k in (1, 2, 17, 30, 59, 60):
        key, ahead = importance.kth_key(rows, k, 3)
        assert tuple(key.values()) == ordered[k - 1] and ahead == ordered.index(ordered[k - 1])


def test_resampling_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = docs.limit(0)
    assert importance.resample(none, docs).count() == 0
    row = importance.resample(docs, none, percent=100, least_words=1).first()
    assert (row.rank, row.n_features, row.weight) == (1, 2, 2 * math.floor(1000 * math.log(10002 / (2 * 10000))))


def test_crc_of_runs():
    texts = ODD + ["x" * 64, "y" * 65, "z" * 1000]
    data = [t.encode() for t in texts if t]
    ends = np.cumsum([len(d) for d in data])
    joined = np.frombuffer(b"".join(data), np.uint8)
    got = importance.crc_on(np.zeros(len(data), np.uint32), joined, np.append(0, ends[:-1]), ends)
    assert got.tolist() == [zlib.crc32(d) for d in data]


# --- fill in the middle -----------------------------------------------------------

def brute_fim(i, text, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    d = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, len(units), "plain", None, None, text, text
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    out = f"<S>{suf}<P>{pre}<M>{mid}" if h[3] % 100 < 20 else f"<P>{pre}<S>{suf}<M>{mid}"
    return i, len(units), "spm" if h[3] % 100 < 20 else "psm", len(pre), len(mid), out, text


def test_infill_against_brute_force(spark):
    rng = random.Random(4)
    pool = "abZ é東😀\n1<>-\u0301"
    texts = ODD + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 50))) for _ in range(300)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "abc def"), (5, "abc"), (5, "abc"), (99999, "long " * 200000)]
    docs = spark.createDataFrame([(i, t, "n", 3) for i, t in rows], "doc_id long, text string, form string, output int").repartition(3)
    got = sorted((tuple(r) for r in infill.fill_in_middle(docs).collect()), key=str)
    assert got == sorted((brute_fim(i, t) for i, t in rows), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(docs.limit(0)).count() == 0


def test_unit_marks_rank_and_select():
    for a, b, data, offsets in slices(pa.array(ODD), 64):
        words = infill._words(data)
        marks = infill.Marks(infill.unit_ends(words, offsets))
        want = []
        for t, at in zip(ODD[a:b], offsets[:-1].tolist()):
            for u in re.findall(r"[A-Za-z]+|[^A-Za-z]", t or ""):
                at += len(u.encode())
                want.append(at - 1)
        n = int(marks.rank(offsets)[-1])
        assert n == len(want) and (not n or marks.select(np.arange(1, n + 1)).tolist() == want)


def peak_bytes(fn):
    tracemalloc.start()
    try:
        fn()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_keys_of_bytes_and_words_take_little_memory():
    words = random.Random(5).choices(["of", "the", "measure", "weighing"], k=300_000)
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    offsets = np.linspace(0, len(data), 301).astype(np.int64)
    assert peak_bytes(lambda: context_tree.string_keys(data, offsets)) < 24 * len(data)
    assert peak_bytes(lambda: context_tree.word_keys(data, offsets)) < 16 * len(data)


def test_merged_runs_take_one_more_copy_at_most():
    rng = np.random.default_rng(7)
    runs = [(np.unique(rng.integers(0, 1 << 40, 1_500_000)), None), *((np.unique(rng.integers(0, 1 << 40, 90_000)), None) for _ in range(5))]
    runs = [(k, np.arange(len(k))) for k, _ in runs]
    rows = sum(len(k) for k, _ in runs)
    counter = context_tree.Counter()
    counter.held = runs
    assert peak_bytes(counter.merged) < 44 * rows
    keys, n = counter.merged()
    want_keys, want_n = context_tree.summed(np.concatenate([k for k, _ in runs]), np.concatenate([m for _, m in runs]))
    assert np.array_equal(keys, want_keys) and np.array_equal(n, want_n)
