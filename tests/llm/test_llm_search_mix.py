"""Top-k search, source mixing, decontamination."""

import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlight.llm import decontam, mixing, topk_search


def brute_top(rows, is_query, k):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, q in good:
        if is_query(qi):
            hits = sorted((-min(sum(a * b for a, b in zip(q, v)), 2 ** 63 - 1), i) for i, v in good if i != qi)[:k]
            out += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(hits)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_topk_against_brute_force(spark, small, monkeypatch):
    if small:                                             # many ranges, chunks and blocks
        monkeypatch.setattr(topk_search, "RANGE", (16, 16))
        monkeypatch.setattr(topk_search, "CHUNK", (4, 4))
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(6) * (i % 3)]) for i in range(120)]
    rows += [(200 + i, [0.5] * 6) for i in range(40)]                    # ties
    rows += [(300, None), (301, [1.0, None] + [0.0] * 4), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, [1.0, 2.0]), (305, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    got = sorted(map(tuple, topk_search.search(df, F.col("vec_id") % 5 == 0, 7).collect()))
    as_float = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == brute_top(as_float, lambda i: i % 5 == 0, 7)


def test_topk_large_numbers_and_few_rows(spark):
    rows = [(0, [2.0 ** 30, 2.0 ** 25]), (5, [2.0 ** 24 + 1 / 64, 1.0]), (7, [-1.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk_search.search(df, F.col("vec_id") % 5 == 0, 20).collect()))
    assert got == brute_top(rows, lambda i: i % 5 == 0, 20)
    assert topk_search.search(df.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("small", [False, True])
def test_topk_outliers_long_vectors_and_the_ends_of_doubles(spark, small, monkeypatch):
    """A few rows beyond 2^53 leave the others to the blocks; a long one widens no others."""
    if small:
        monkeypatch.setattr(topk_search, "RANGE", (16, 16))
        monkeypatch.setattr(topk_search, "CHUNK", (4, 4))
        monkeypatch.setattr(topk_search, "BOUNDS", 5)
        monkeypatch.setattr(topk_search._Ends, "most", 3)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(4)]) for i in range(150)]
    rows += [(150 + i, [float(x) for x in rng.standard_normal(4) * 10.0 ** (3 + i)]) for i in range(16)]
    rows += [(170 + i, [2.0 ** 40, 1.0 + i % 2, 2.0 ** -6 * i, -(2.0 ** 40)]) for i in range(24)]       # sums that doubles round
    rows += [(200, [1e300, 1.0, 0.0, 0.0]), (201, [-1e300, 1e300, 1e300, 0.0]), (205, [2.0] * 700), (206, [1.0] * 3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    def clipped(q, v):
        return max(-(2 ** 63 - 1), min(2 ** 63 - 1, sum(int(a) * int(b) for a, b in zip(q, v))))

    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    want = []
    for qi, q in good:
        if qi % 5 == 0:
            hits = sorted((-clipped(q, v), i) for i, v in good if i != qi)[:7]
            want += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(hits)]
    got = sorted(map(tuple, topk_search.search(df, F.col("vec_id") % 5 == 0, 7).collect()))
    assert got == sorted(want)
    # Beyond the doubles after the 64-fold: the largest double, no crash.
    far = spark.createDataFrame([(0, [1e307, 1.0]), (5, [-1e308, 0.0]), (6, [1.0, 1.0]), (7, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk_search.search(far, F.col("vec_id") % 5 == 0, 2).collect()))
    assert got == [(0, 1, 6, 2 ** 63 - 1), (0, 2, 7, 2 ** 63 - 1), (5, 1, 0, -(2 ** 63 - 1)), (5, 2, 6, -(2 ** 63 - 1))]


def test_careful_scores_few_rows_again(monkeypatch):
    """One outlier query against many rows: integers only where doubles leave it open."""
    rng = np.random.default_rng(3)
    vectors = np.floor(rng.standard_normal((5000, 8)) * 64)
    query = np.floor(rng.standard_normal(8) * 2.0 ** 55)
    calls, exact = [], topk_search._exact
    monkeypatch.setattr(topk_search, "_exact", lambda i, q, v: calls.append(len(v)) or exact(i, q, v))
    ids, scores = topk_search._careful(np.arange(5000), vectors, -1, query, 20)
    want = sorted((-s, i) for i, s in enumerate(exact(None, query, vectors)))[:20]
    assert [(-int(s), int(i)) for i, s in zip(ids, scores)] == want and sum(calls) <= 40


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 6)), min_size=1, max_size=6, unique_by=lambda x: x[0]), st.integers(0, 300))
def test_budget_fit_is_the_best_subset_sum(pieces, budget):
    lengths, counts = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
    take = mixing.fit_counts(lengths, counts, budget)
    assert ((0 <= take) & (take <= counts)).all()
    assert (take * lengths).sum() <= budget
    # Whatever the proportional start leaves open, the dynamic programme closes exactly
    # if its pieces can; with all pieces open the result is the best possible.
    share = np.array([int(c) * budget // max(int((lengths * counts).sum()), 1) for c in counts]).clip(0, counts)
    free = counts - share
    sums = {0}
    for length, n in zip(lengths.tolist(), free.tolist()):
        sums = {s + length * i for s in sums for i in range(n + 1)}
    left = budget - int((share * lengths).sum())
    if budget < int((lengths * counts).sum()):
        assert left - max(s for s in sums if s <= left) == budget - int((take * lengths).sum())


def test_targets_share_the_excess(spark):
    def targets(rows, **kw):
        df = spark.createDataFrame(rows, "s string, mix_source_size long, _weight double")
        return {r.s: r.mix_target for r in mixing.targets(df, **kw).collect()}

    t = targets([("a", 100, 1.0), ("b", 100, 2.0), ("c", 10, 3.0), (None, 40, 1.0)])
    assert t["c"] == 30 and abs(sum(t.values()) - 250) < 1e-9 and abs(t["b"] - 2 * t["a"]) < 1e-9 and abs(t["a"] - t[None]) < 1e-9
    assert targets([]) == {} and targets([("a", 0, 1.0)]) == {"a": 0.0}
    assert targets([("a", 10, 1.0), ("b", 20, 5.0)], max_repeats=0.5) == {"a": 5.0, "b": 10.0}       # all at their limit
    # Round after round another source reaches its limit: thousands of them, as of hosts.
    rng = np.random.default_rng(4)
    sizes = {f"h{i}": int(x) for i, x in enumerate(rng.pareto(0.6, 3000) * 10 + 1)}
    weights = {s: i % 3 + 1 for i, s in enumerate(sizes)}
    t, want = targets([(s, n, float(weights[s])) for s, n in sizes.items()]), exact_targets(sizes, weights)
    assert all(abs(t[s] - float(want[s])) <= 1e-6 * float(want[s]) for s in sizes)


def test_budget_fit_holds_one_number_a_word():
    """Long documents of many lengths: what is held does not grow with their number."""
    import tracemalloc
    lengths, counts = np.arange(10_001, 200_001, 97) * 2, np.full(1959, 3)
    tracemalloc.start()
    take = mixing.fit_counts(lengths, counts, 700_001)                      # odd: out of reach, so every piece is tried
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    sums = 1
    for length in np.repeat(lengths, 3).tolist():
        sums |= sums << length & (1 << 700_002) - 1
    assert (take * lengths).sum() == sums.bit_length() - 1 and peak < 40e6


def exact_targets(sizes, weights):
    open_, left, out = set(sizes), Fraction(sum(sizes.values())), {}
    while open_:
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / total > 3 * sizes[s]}
        if not over:
            return out | {s: left * weights[s] / total for s in open_}
        for s in over:
            out[s] = Fraction(3 * sizes[s])
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PLAN_ROWS", 5)                   # the shuffled plan
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), ["b", "a", "\U0001F600", "\uffff", None][i % 5] if i % 3 else "hot", 1) for i in range(300)]
    rows += [(1000 + i, "one two three", "hot", 1) for i in range(500)]                 # a hot length
    rows += [(2000, None, "a", 1), (2001, " \t\n ", "a", 1), (2002, "a\u00a0b\u2003c d", "only", 1), (2002, "a\u00a0b\u2003c d", "only", 1), (2003, "", "nil", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix_sources(docs.repartition(5)).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    import re
    for _, t, s, _ in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = exact_targets(sizes, {s: i % 3 + 1 for i, s in enumerate(names)})
    taken = Counter()
    for r in got:
        assert r.mix_copies <= 3 and r.mix_source_size == sizes[r.source] and abs(r.mix_target - float(want[r.source])) < 1e-6
        taken[r.source] += r.mix_size * r.mix_copies
    for s in names:
        assert abs(taken[s] - float(want[s])) <= (2 if s == "only" else 1), s
    again = mixing.mix_sources(docs).collect()
    assert sorted((r.doc_id, r.mix_copies) for r in got) == sorted((r.doc_id, r.mix_copies) for r in again)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


ITEMS = [(1, "What is the tallest mountain of the northern range? It is Mount Kelvar, named by surveyors."),
         (2, "Lists of rivers often omit the small Ostrel which flows west"), (3, None), (4, " "),
         (5, " ".join(f"word{i}" for i in range(130)) + ". " + " ".join(f"end{i}" for i in range(10)) + "."),
         (2, "Lists of rivers often omit the small Ostrel which flows west")]


def brute_contaminated(text, items):
    """Every window of words against every segment, without any pruning."""
    words = decontam.hashed_words(text)
    segs = list({(i, n, tuple(w), q) for i, t in items for i, n, w, q in decontam.segments(i, t)})
    df = Counter(w for _, _, ws, _ in segs for w in set(ws))
    mean = sum(len(s[2]) for s in segs) / len(segs)
    out = set()
    for item, _, ws, q in segs:
        tf = Counter(ws)
        norm = decontam.K1 * (1 - decontam.B + decontam.B * len(ws) / mean)
        w = {t: math.log(1 + (len(segs) - df[t] + .5) / (df[t] + .5)) * n * (decontam.K1 + 1) / (n + norm) for t, n in tf.items()}
        for at in range(0, max(len(words), 1), decontam.UNIT):
            p = words[at:at + 2 * decontam.UNIT]
            if sum(v for t, v in w.items() if np.int64(t).view(np.uint64) in p) / sum(w.values()) < decontam.THRESHOLD:
                continue
            u = np.array(ws, np.int64).view(np.uint64)
            g, a = np.unique(decontam.shingle_hashes(u[:q], 3)), np.unique(u[q:])
            if (not len(g) or np.isin(g, decontam.shingle_hashes(p, min(q, 3))).mean() >= .5) and (not len(a) or np.isin(a, p).mean() >= .5):
                out.add(item)
    return out


@pytest.mark.parametrize("max_postings", [10, 10 ** 6])
def test_decontamination_against_brute_force(spark, max_postings):
    pad = " ".join(f"filler{i}" for i in range(150))
    texts = [None, "", pad, ITEMS[0][1], f"{pad} {ITEMS[0][1].upper()} {pad}", f"{pad} {ITEMS[1][1]}\n{pad}", ITEMS[4][1],
             "the of is it by named small west", ITEMS[0][1].replace("northern", "southern"), ITEMS[0][1].split("?")[0],
             pad * 40 + " " + ITEMS[1][1], ITEMS[1][1]]
    docs = spark.createDataFrame([(i, t, 0.0) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.contaminated(docs, items, max_postings).collect()
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    want = {(i, x) for i, t in enumerate(texts) for x in brute_contaminated(t, ITEMS)}
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert {(3, 1), (4, 1), (5, 2), (6, 5), (8, 1), (10, 2), (11, 2)} <= want and not {0, 1, 2, 7, 9} & {d for d, _ in want}
    kept = decontam.clean(docs, items, max_postings)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in want}


def test_decontamination_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[2:4], "item_id long, text string")
    assert decontam.contaminated(docs, items).count() == 0 and decontam.clean(docs, items).count() == 1
    assert decontam.contaminated(docs.limit(0), spark.createDataFrame(ITEMS[:1], "item_id long, text string")).count() == 0


FOREIGN = [(1, "¿Cuál es la montaña más alta de la región? Está en Ávila, según señalan Íñigo y Óscar."),
           (2, "À l'été, où était né l'élève âgé ? Près d'Évian, à côté du château, là où coule l'Ève."),
           (3, "Wofür müssen Käufer größere Äpfel während der Übergangszeit prüfen? Für übliche Fäule, natürlich außen.")]


def plain_words(text):
    """Words by str.lower (capitals of ß are SS), without punctuation at their edges."""
    out = []
    for w in text.lower().replace("ß", "ss").split():
        while len(w) > 1 and not w[0].isalnum():
            w = w[1:]
        while len(w) > 1 and not w[-1].isalnum():
            w = w[:-1]
        out.append(w)
    return out


def test_decontamination_folds_case_and_edges_of_all_letters(spark):
    pad = " ".join(f"füller{i}" for i in range(100))
    texts = [f(t) for _, t in FOREIGN for f in (str, str.upper, str.title, lambda t: " ".join(f"«{w.strip('.,?¿')}»…" for w in t.split()))]
    docs = [(i, f"{pad} {t}\n{pad}") for i, t in enumerate(texts)] + [(100, pad.upper()), (101, None)]
    held = lambda t, item: f" {' '.join(plain_words(item))} " in f" {' '.join(plain_words(t or ''))} "
    want = {(i, n) for i, t in docs for n, item in FOREIGN if held(t, item)}
    assert {(4 * k + f, k + 1) for k in range(3) for f in (0, 1, 2)} <= want
    df, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(FOREIGN, "item_id long, text string")
    got = decontam.contaminated(df, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want | {(3, 1), (7, 2), (11, 3)}
    assert all(r.score > 0.9 for r in got)
    assert {r.doc_id for r in decontam.clean(df, items).collect()} == {100, 101}


def test_decontamination_words_keep_their_number_and_accents():
    fold = lambda t: decontam.fold(t.encode()).decode()
    assert fold("ÉTÉ ! (Straße) — l'Œuvre, x_y C++ ... ") == "été strasse — l'œuvre x_y c ..."
    assert fold("Ete") != fold("Été") and decontam.fold(b"\xff A\xc3") == b"\xff a\xc3"


def test_word_folding_by_bytes_equals_folding_by_characters():
    import random

    import pyarrow as pa

    from ledgerlight.llm.common import slices, word_hashes, word_spans
    rng = random.Random(3)
    pool = "aZé É÷×ßçÀÿŸ—…  .,!?-'\"()_~$ \t\n0٣Kıİŉ\u0301œŒ\U0001F600\x01\x7fÃ\u0085ñΣς"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + [None, "", " ", "..."]
    for _, _, data, offsets in slices(pa.array(texts), 1 << 12):
        got, first = decontam.folded_words(data, offsets)
        whole = [decontam.fold(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        joined, cuts = np.frombuffer(b"".join(whole), np.uint8), np.cumsum([0, *map(len, whole)])
        starts, ends, of = word_spans(joined, cuts)
        assert (first == of).all() and (got == word_hashes(joined, starts, ends)).all()
