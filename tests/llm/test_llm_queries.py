"""Queries against their SQL, and the whole pipeline."""

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from ledgerlight.llm import decontam, minhash_dedup, quality
from ledgerlight.llm.queries import ORACLE, QUERIES
from tools.check_oracle import check_one, duck_connection

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    status, msg, _ = check_one(spark, duck_connection(SF), SF, name, QUERIES[name], ORACLE[name])
    assert status == "OK", msg


def test_every_operator_has_one_query():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(f"op{i}" for i in range(1, 14))


@pytest.mark.parametrize("name", ["op4_chat_format", "op7_pii"])
def test_native_queries_start_no_python_worker(spark, name, monkeypatch):
    """Neither the result's plan nor that of any table written on the way."""
    from pyspark.sql import DataFrameWriter
    plans, parquet = [], DataFrameWriter.parquet
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: plans.append(plan_of(w._df)) or parquet(w, *a, **k))
    plans.append(plan_of(QUERIES[name](spark, SF)))
    assert (len(plans) > 1) == (name == "op7_pii") and not any(re.search("Python|Pandas|Arrow", p) for p in plans)


def one_of_each(texts):
    """The smallest id of every group of texts that share 8 in 10 of their 5-word shingles: all pairs with a common one."""
    sets, holders = {}, defaultdict(list)
    for i, text in texts.items():
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())      # of bytes, lower() folds A-Z only
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in sorted(sets):
        shared = Counter()
        for s in sets[i]:
            shared.update(holders[s])
            holders[s].append(i)
        for j, n in shared.items():
            if 10 * n >= 8 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    return {i for i in sets if root(i) == i}


def test_pipeline_stage_by_stage(spark):
    """Each stage's rows against what its operator says about all of its input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    kept = {}
    last = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, last, SF)
        rows = out.collect()
        if name == "quality":
            model = quality.fit(last, spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality"), _true())
            want = {r.doc_id for r in quality.scored(last, model, corpus_pipeline.KEEP_SCORE).where("quality_pred = 1").collect()}
        elif name == "near_duplicates":
            want = one_of_each({i: r.text for i, r in kept["last"].items()})
            assert want == {r.doc_id for r in minhash_dedup.near_duplicates(last, 5, (8, 10)).where("kept").collect()}
        elif name == "decontamination":
            items = spark.read.parquet(f"{SF}/benchmark.parquet")
            want = set(kept["last"]) - {r.doc_id for r in decontam.contaminated(last, items).collect()}
            held = [i.text for i in items.collect()]
            assert not any(t in (r.text or "") for t in held for r in rows)
        else:
            want = {r.doc_id for r in rows} if name == "mixing" else set(kept["last"])
        assert {r.doc_id for r in rows} == want and len(rows) == len(want), name
        if name != "mixing":
            assert out.columns == names
            assert all(r.n_chars == len(r.text) for r in rows)
        kept["last"] = {r.doc_id: r for r in rows}
        last = spark.createDataFrame(rows, out.schema)
    assert kept["last"] and all(r.mix_copies > 0 for r in kept["last"].values())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "mixing"]


def _true():
    from pyspark.sql import functions as F
    return F.lit(True)


def test_pipeline_on_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_on_odd_rows(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10 ** 9, None, None, None, None), (10 ** 9 + 1, "", "en", None, 0), (10 ** 9 + 2, "word " * 30000, None, "src0", 150000)],
                                docs.schema)
    docs.unionByName(odd).unionByName(docs.limit(5)).write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)
