"""Quality and language classifiers: held-out accuracy, brute force, edge rows."""

import math
import re
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlight.llm import langid, quality
from ledgerlight.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_quality_held_out(spark):
    rows = {r.doc_id: r for r in QUERIES["op6_quality"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(rows) == docs.count()
    labels = [(r.quality, rows[r.doc_id]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    held = [(y, r) for y, r in labels if r.held_out]
    assert len(held) > 50 and sum(y == r.predicted for y, r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())


def test_quality_votes_against_brute_force():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(words, 30)) + (" ###" * 5 if i % 2 else "") for i in range(60)]
    chunks = list(quality._all(pa.array(texts)))
    idf = np.ones(quality.DIM, np.float32)
    dense = np.concatenate([quality._dense(n, d, t, c, idf) for n, d, t, c, _ in chunks])
    space = quality._latent(dense, 8)
    vectors = quality._unit(dense @ space)
    labels = np.array([float(i % 2 == 0) for i in range(60)])
    model = quality.Model(idf, space, vectors, labels, 0.25)
    got = model.score(pa.array([*texts, None, "", " \n"]))
    for i in range(60):
        near = [float(vectors[i].astype(float) @ v) for v in vectors]
        best = sorted(range(60), key=lambda j: -near[j])[:quality.NEIGHBOURS]
        w = [max(near[j], 0) ** 4 for j in best]
        assert abs(got[i] - sum(a * labels[j] for a, j in zip(w, best)) / sum(w)) < 1e-3
    assert got[60:].tolist() == [0.25] * 3
    # The latent space is that of the exact decomposition.
    _, _, v = np.linalg.svd(dense, full_matrices=False)
    assert np.linalg.norm(dense @ space) / np.linalg.norm(dense @ v[:8].T) > 0.98


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, "a b c", "x"), (2, None, "x"), (3, "", "x"), (3, "", "x"), (None, "A B " * 20000, "x"), (4, "!!! ###", "x")],
                                 "doc_id long, text string, quality string")
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    assert quality.fit(docs, none, F.lit(True)) is None
    assert {r.quality_score for r in quality.scored(docs, None).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (4, 0), (None, 1), (77, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.lit(True))
    got = {r.doc_id: r.quality_score for r in quality.scored(docs, model).collect()}
    assert set(got) == {1, 2, 3, 4, None} and got[2] == 0 == got[3] and all(0 <= s <= 1 for s in got.values())
    assert quality.scored(docs.limit(0), model).count() == 0
    only = quality.fit(docs, spark.createDataFrame([(3, 0)], "doc_id long, quality int"), F.lit(True))
    assert all(r.quality_score == 0 for r in quality.scored(docs, only).collect())


def test_shapes_tell_classes_apart():
    data = np.frombuffer(b"Word word WORD w0rd word!! word## wxyz", np.uint8)
    from ledgerlight.llm.common import word_spans
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    s = quality._shapes(data, starts, ends)
    assert s[1] == s[6] and len(set(s.tolist())) == 6


def test_langid_held_out(spark):
    rows = {r.doc_id: r for r in QUERIES["op10_langid"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    held = [(d.lang, rows[d.doc_id]) for d in docs if rows[d.doc_id].held_out and d.lang]
    assert len(held) > 100 and sum(y == r.lang_pred for y, r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_langid_features_against_brute_force():
    texts = ["Ab, cd!", "", "1 2 3", "été ñ", "aaaa", "Да x"]
    doc, gram, n, has = langid.features([t.lower() for t in texts])
    assert has.tolist() == [True, False, False, True, True, True]
    for i, t in enumerate(texts):
        seen = "".join(c if c.isalpha() else " " for c in t.lower())
        kept = "".join(c for j, c in enumerate(seen) if c != " " or j and seen[j - 1] != " ")
        if not any(c.isalpha() for c in kept):
            assert n[doc == i].sum() == 0
            continue
        kept = kept if kept[0] != " " else kept[1:]
        assert n[doc == i].sum() == sum(max(len(kept) - k + 1, 0) for k in (1, 2, 3))
    alone = langid.features([texts[3].lower()])
    assert sorted(zip(gram[doc == 3], n[doc == 3])) == sorted(zip(alone[1], alone[2]))


def test_ftrl_is_sparse_and_separates():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        y = i % 3
        at = np.unique(np.concatenate([rng.integers(100 * y, 100 * y + 40, 15), rng.integers(5000, 9000, 10)]))
        rows.append((at, np.ones(len(at)) / np.sqrt(len(at)), y))
    w, b = langid.train_ftrl(rows[:90], 3)
    assert (w != 0).any() and (w == 0).mean() > 0.8
    logits = np.array([x @ w[at] + b for at, x, _ in rows[90:]])
    y = np.array([r[2] for r in rows[90:]])
    assert (logits.argmax(axis=1) == y).mean() > 0.9
    heat = langid.temperature(logits, y)
    loss = lambda t: -np.log(langid._softmax(logits / t)[np.arange(len(y)), y]).mean()
    assert loss(heat) <= loss(1.0) + 1e-9 and langid.temperature(logits[:0], y[:0]) == 1.0


def test_langid_edges(spark):
    docs = spark.createDataFrame([(1, "abc abc", "aa"), (2, "xyz xyz", "bb"), (3, None, "aa"), (4, "12 !", "aa"), (None, "abc", None),
                                  (2, "xyz xyz", "bb"), (5, "ab" * 60000, None)], "doc_id long, text string, lang string")
    assert langid.fit(docs.where("lang is null"), F.lit(True)) is None
    assert langid.fit(docs.where("doc_id in (3, 4)"), F.lit(True)) is None
    assert {(r.lang_pred, r.score) for r in langid.identify(docs, None).collect()} == {("und", 0.0)}
    model = langid.fit(docs, F.lit(True))
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.identify(docs, model).collect()]
    assert len(got) == 7 and {(d, p) for d, p, _ in got if d in (1, 2, 3, 4)} == {(1, "aa"), (2, "bb"), (3, "und"), (4, "und")}
    assert all(s == 0 for d, p, s in got if p == "und") and langid.identify(docs.limit(0), model).count() == 0


def test_langid_limit_shortens_all_languages_alike(spark, monkeypatch):
    """20 languages of 600 rows, 9 of 20 and one of 1, where the limit holds a third of the thinned rows."""
    size = {chr(0x430 + k): 600 if k < 20 else 20 if k < 29 else 1 for k in range(30)}
    texts = [(c * 3 + " " + c * (1 + i % 5), c) for c, n in size.items() for i in range(n)]
    docs = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(texts)], "doc_id long, text string, lang string")
    real, seen = langid.train_ftrl, []
    monkeypatch.setattr(langid, "train_ftrl", lambda rows, classes: seen.append(rows) or real(rows, classes))
    monkeypatch.setattr(langid, "LEAST", 2, raising=False)
    model = langid.fit(docs, F.lit(True), per_language=30, max_train=300)
    learned = np.bincount([y for *_, y in seen[0]], minlength=30)
    assert model.names == sorted(size) and 240 <= len(seen[0]) <= 260
    assert learned[29] == 1 and learned[:29].min() >= 3 and learned[20:29].mean() > 0.7 * learned[:20].mean()
    got = langid.identify(docs.select("doc_id", "text"), model).join(docs, "doc_id").select("lang", "lang_pred").distinct().collect()
    # One row is learned from, but too few to be told apart for certain.
    assert {(r.lang, r.lang_pred) for r in got if size[r.lang] > 1} == {(c, c) for c in size if size[c] > 1}
    # Many languages: the limit gives way, every language is learned.
    monkeypatch.setattr(langid, "LEAST", 10)
    assert langid.fit(docs, F.lit(True), per_language=30, max_train=20).names == sorted(size)


def test_language_model_learns_nothing_from_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    held = F.col("doc_id") % 3 == 0
    changed = docs.withColumn("text", F.when(held, F.lit("zzz qqq")).otherwise(F.col("text"))).withColumn(
        "lang", F.when(F.col("doc_id") % 7 == 1, F.lit(None)).otherwise(F.col("lang")))
    same = docs.withColumn("lang", F.when(F.col("doc_id") % 7 == 1, F.lit(None)).otherwise(F.col("lang")))
    a, b = langid.fit(same, ~held), langid.fit(changed, ~held)
    assert a.names == b.names and a.heat == b.heat
    assert (a.weights == b.weights).all() and (a.bias == b.bias).all() and (a.idf == b.idf).all()


def plain_grams(text):
    """Hashed 1- to 3-grams of a text and their counts, one character after another."""
    out, points = Counter(), []
    for c in text.lower():
        if c.isalpha():
            points.append(ord(c))
        elif points and points[-1] != 32:
            points.append(32)
    for i in range(len(points)):
        h = 0
        for n, odd in enumerate((0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)):
            if i + n == len(points):
                break
            h = (h + points[i + n]) * odd % 2 ** 32
            bits = (h ^ h >> 15) * 0x2C1B3C6D % 2 ** 32
            out[(bits ^ bits >> 13) % langid.DIM] += 1
    return out


def plain_tfidf(text, idf):
    w = {g: (1 + math.log(n)) * idf(g) for g, n in plain_grams(text).items()}
    norm = math.sqrt(sum(x * x for x in w.values()))
    return {g: x / norm for g, x in w.items()}


def softmax(z):
    e = [math.exp(x - max(z)) for x in z]
    return [x / sum(e) for x in e]


def plain_ftrl(rows, classes):
    """One weight at a time: (gram, class) to z and n; the bias is gram None."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(k):
        return 0.0 if abs(z[k]) <= langid.L1 else -(z[k] - math.copysign(langid.L1, z[k])) / ((langid.BETA + math.sqrt(n[k])) / langid.ALPHA + langid.L2)

    order = np.random.default_rng(5)
    for _ in range(langid.EPOCHS):
        for i in order.permutation(len(rows)):
            x, y = rows[i]
            x = x | {None: 1.0}
            w = {(g, c): weight((g, c)) for g in x for c in range(classes)}
            p = softmax([sum(v * w[g, c] for g, v in x.items()) for c in range(classes)])
            for (g, c), old in w.items():
                grad = x[g] * (p[c] - (c == y))
                z[g, c] += grad - (math.sqrt(n[g, c] + grad * grad) - math.sqrt(n[g, c])) / langid.ALPHA * old
                n[g, c] += grad * grad
    return weight


def test_langid_training_and_prediction_against_brute_force(spark):
    """Frequencies, sample order, training, temperature and predictions, each computed without the operator."""
    rng = np.random.default_rng(8)
    words = {"aa": ["der", "und", "nicht", "ÜBER"], "bb": ["the", "and", "over", "not"], "cc": ["это", "и", "не", "the"]}
    rows = [(i, " ".join(rng.choice(words[g], 5)) + ["", ". ", " 12!"][i % 3], g) for i, g in enumerate(rng.choice(list(words), 90).tolist())]
    docs = spark.createDataFrame(rows + [(200, "12 3", "aa"), (201, "der and", None), (202, None, None), (203, "и и the", None)],
                                 "doc_id long, text string, lang string").repartition(4)
    model = langid.fit(docs, F.lit(True))
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}

    labelled = rows + [(200, "12 3", "aa")]
    df = Counter(g for _, t, _ in labelled for g in plain_grams(t))
    idf = lambda g: math.log((1 + len(labelled)) / (1 + df[g])) + 1
    place = {r.doc_id: r.h for r in docs.select("doc_id", F.expr("shiftrightunsigned(xxhash64(doc_id, 23), 11)").alias("h")).collect()}
    data = [(plain_tfidf(t, idf), sorted(words).index(g)) for i, t, g in sorted(rows, key=lambda r: place[r[0]])]
    held, kept = data[::5], [d for i, d in enumerate(data) if i % 5]
    weight = plain_ftrl(kept, 3)
    logits = lambda x: [weight((None, c)) + sum(v * weight((g, c)) for g, v in x.items()) for c in range(3)]
    for g in {g for x, _ in data for g in x}:
        assert np.allclose(model.weights[g], [weight((g, c)) for c in range(3)], atol=1e-5)
    assert np.allclose(model.bias, [weight((None, c)) for c in range(3)], atol=1e-5)
    loss = [-sum(math.log(softmax([v / t for v in logits(x)])[y]) for x, y in held) for t in np.geomspace(0.05, 5, 120)]
    assert abs(model.heat - np.geomspace(0.05, 5, 120)[int(np.argmin(loss))]) < 1e-9
    for i, text, _ in rows + [(201, "der and", None), (203, "и и the", None)]:
        p = softmax([v / model.heat for v in logits(plain_tfidf(text, idf))])
        assert got[i].lang_pred == sorted(words)[int(np.argmax(p))] and abs(got[i].score - max(p)) < 1e-4
    assert {(got[i].lang_pred, got[i].score) for i in (200, 202)} == {("und", 0.0)}


def plain_terms(text):
    """Hashed words, word shapes and repeats of a text and their counts, byte by byte."""
    from ledgerlight.llm.common import _BASE, _BYTE
    full, terms, last = 2 ** 64, Counter(), None

    def spread(h):
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % full
        h = (h ^ h >> 27) * 0x94D049BB133111EB % full
        return h ^ h >> 31

    def kind(b):
        c = chr(b)
        return 1 if "A" <= c <= "Z" else 2 if "a" <= c <= "z" or b >= 0x80 else 3 if c.isdigit() else b + 16

    for word in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()):
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in word)
        h = spread((sum(int(_BYTE[b]) * pow(_BASE, i, full) for i, b in enumerate(low)) + len(low)) % full)
        shape = 0
        for k, _ in list(groupby(map(kind, word)))[:8]:
            shape = (shape * 257 + k) % full
        terms[h % (quality.DIM - quality.SHAPES)] += 1
        terms[quality.DIM - quality.SHAPES + 1 + spread(shape) % (quality.SHAPES - 1)] += 1
        terms[quality.DIM - quality.SHAPES] += low == last
        last = low
    return +terms


def test_quality_against_brute_force(spark):
    """Terms, frequencies, the sample's space, cosines and votes, each computed without the operator."""
    rng = np.random.default_rng(6)
    words = ["alpha", "Beta", "GAMMA", "d3lta", "über", "###", "Über", "x-1", "foo.bar", "alpha,", "42"]
    texts = [" ".join(rng.choice(words, int(rng.integers(3, 25)))) + ["", " \n", " beta beta"][i % 3] for i in range(70)]
    docs = spark.createDataFrame([*enumerate(texts), (100, None), (101, " ")], "doc_id long, text string").repartition(3)
    labels = {i: int(rng.integers(0, 2)) for i in range(0, 50, 2)}
    model = quality.fit(docs, spark.createDataFrame([*labels.items(), (101, 1)], "doc_id long, quality int"), F.lit(True))
    got = {r.doc_id: r.quality_score for r in quality.scored(docs, model).collect()}

    df = Counter(t for text in texts for t in plain_terms(text))

    def tfidf(text):
        x = np.zeros(quality.DIM)
        for t, n in plain_terms(text).items():
            x[t] = (1 + math.log(n)) * (math.log((1 + len(texts) + 2) / (1 + df[t])) + 1)
        return x / np.linalg.norm(x)

    sample = np.array([tfidf(texts[i]) for i in labels])
    _, s, v = np.linalg.svd(sample, full_matrices=False)           # fewer rows than directions: the whole space of the sample
    space = v[s > 1e-9].T
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    near, y = unit(np.array([tfidf(t) for t in texts]) @ space) @ unit(sample @ space).T, np.array(list(labels.values()))
    for i in range(len(texts)):
        best = sorted(range(len(y)), key=lambda j: -near[i, j])[:quality.NEIGHBOURS]
        w = [max(near[i, j], 0) ** 4 for j in best]
        assert abs(got[i] - sum(a * y[j] for a, j in zip(w, best)) / sum(w)) < 2e-3, i
    assert got[100] == got[101] == 1                               # the learned text without words
