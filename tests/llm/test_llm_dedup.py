"""Near-duplicates and components against brute force."""

import random

import numpy as np
import pytest

from ledgerlight.llm import minhash_dedup
from ledgerlight.llm.components import components


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n, num, den):
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t, n)) for i, t in rows]
    for a, (i, s) in enumerate(sets):
        for j, u in sets[:a]:
            if i == j or s and u and den * len(s & u) >= num * len(s | u):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in rows}, dict(sets)


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("mnop") + str(rng.randrange(60))
    rows, i = [], 0
    for _ in range(12):                               # groups of edited copies, some chained
        base = [word() for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(rng.choice([3, 12])):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((i, " ".join(copy)))
            i += 1
            if rng.random() < 0.3:
                base = copy
    rows += [(1000 + k, " ".join(word() for _ in range(60))) for k in range(40)]
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "two words"), (2004, "TWO  words"), (2005, "one"), (2006, "a b c"),
             (2007, "a b c"), (2007, "a b c"), (2008, rows[0][1].upper()), (2009, "x y z q"), (2010, " ".join(["same"] * 9000))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,similarity,block", [(3, (85, 100), 1024), (5, (8, 10), 1024), (3, (85, 100), 4)])
def test_components_against_brute_force(spark, n, similarity, block, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, sig string").repartition(4)
    got = minhash_dedup.near_duplicates(df, n, similarity).collect()
    want, sets = brute(rows, n, *similarity)
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.doc_id == r.component_id) for r in got)


def test_one_document_of_each_group(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n string").repartition(3)
    kept = minhash_dedup.one_of_each(df)
    assert kept.columns == df.columns
    want, _ = brute(rows, 5, 8, 10)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i, _ in rows if want[i] == i})
    assert minhash_dedup.near_duplicates(df.limit(0)).count() == 0 and minhash_dedup.one_of_each(df.limit(0)).count() == 0


def test_only_unlike_documents(spark):
    df = spark.createDataFrame([(5, "a b c d e"), (2, "f g h i j"), (9, None)], "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.kept, r.n_shingles) for r in minhash_dedup.near_duplicates(df).collect()}
    assert got == {5: (5, True, 3), 2: (2, True, 3), 9: (9, True, 0)}


def test_posterior_bounds():
    least = minhash_dedup.min_matches(85, 100)
    assert len(least) == 4 and all(a < b for a, b in zip(least, least[1:]))
    rng = np.random.default_rng(0)
    pruned = sum((rng.random(128) < 0.85).cumsum()[[31, 63, 95, 127]].__lt__(least).any() for _ in range(20000))
    assert pruned <= 5                                        # pairs at the threshold are kept
    assert sum((rng.random(128) < 0.4).sum() >= least[-1] for _ in range(2000)) == 0


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 80)], [(99, i) for i in range(80)],
                                   [(5, 5), (3, 4), (4, 3), (7, 8), (8, 9), (20, 3)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    for a, b in edges:
        if a != b:
            want.setdefault(a, a), want.setdefault(b, b)
    for _ in want:
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want


def test_repeated_ids_with_different_texts(spark):
    """Texts of one id are one document to ``near_duplicates``; ``one_of_each`` loses no text."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (7, b + " more"), (9, c), (9, None), (9, ""), (None, a), (None, "only here it is said"), (5, b), (11, a.upper())]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, rep string").repartition(3)
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(df).collect()}
    assert got == {(3, 38, 3, True), (5, 38, 3, False), (7, 39, 3, False), (9, 38, 9, True), (9, 0, 9, True), (None, 38, 3, True),
                   (None, 3, None, True), (11, 38, 3, False)}
    kept = sorted(((r.doc_id, r.text) for r in minhash_dedup.one_of_each(df).collect()), key=str)
    assert kept == sorted([(3, a), (5, b), (9, c), (9, None), (None, a), (None, "only here it is said")], key=str)


def test_one_of_each_against_brute_force_with_repeated_ids(spark):
    rng = random.Random(11)
    rows = [(rng.randrange(40), t) for _, t in corpus(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    near, sets = brute(rows, 3, 85, 100)
    got = minhash_dedup.near_duplicates(df).collect()
    assert {r.doc_id: r.component_id for r in got if r.n_shingles} == {i: c for i, c in near.items() if any(j == i and shingles(t, 3) for j, t in rows)}
    texts = list(enumerate(t for _, t in rows if shingles(t, 5)))
    alike, _ = brute(texts, 5, 8, 10)                                 # components of texts, whatever their ids
    groups: dict = {}
    for k, t in texts:
        groups.setdefault(alike[k], set()).add(t)
    kept = [(r.doc_id, r.text) for r in minhash_dedup.one_of_each(df).collect() if shingles(r.text, 5)]
    assert len(kept) == len(groups) and all(sum(t in g for _, t in kept) == 1 for g in groups.values())
    assert all(i == min(j for j, u in rows if u in g) for g in groups.values() for i, t in kept if t in g)
