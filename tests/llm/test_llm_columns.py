"""Operators and pipeline stages on documents with further columns, named like the operators' own."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlight.llm import context_tree, decontam, importance, infill, langid, minhash_dedup, mixing, pii, quality

SF = "/root/testdata/sf0.001"
#: Working and result columns of all operators.
NAMES = ["n", "extra", "passes", "gone", "_cell", "_rows", "_hash", "_attempts", "_row", "_src", "_known", "_size", "_h", "_last", "quality_score",
         "quality_pred", "mix_size", "mix_copies", "mix_source_size", "mix_target", "rep", "key", "k1", "n_shingles", "component_id", "kept", "sig",
         "score", "rank", "weight", "bucket", "block", "pack", "learn", "form", "output", "restored", "item_id", "h", "lang_pred", "attempt", "with space", "do.t"]


@pytest.fixture(scope="module")
def wide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs.select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in NAMES]).cache()


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_pass_columns_through(spark, wide, stage):
    fn = dict(corpus_pipeline.STAGES)[stage]
    out, plain = fn(spark, wide, SF), fn(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    added = [c for c in plain.columns if c.startswith("mix_")]
    same = [n for n in NAMES if n not in added]
    assert set(out.columns) == set(wide.columns) | set(added)
    rows = out.collect()
    assert sorted(map(str, [tuple(r[c] for c in plain.columns) for r in rows])) == sorted(map(str, [tuple(r) for r in plain.collect()]))
    assert rows and all(r[n] == f"{n}:{r.doc_id}" for r in rows for n in same)


def test_operators_take_wide_tables(spark, wide):
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = F.col("doc_id") % 3 != 1
    model, kinds = quality.fit(plain, labels, F.lit(True)), langid.fit(plain, F.lit(True))
    for run in (lambda d: mixing.mix_sources(d).select("doc_id", "mix_size", "mix_copies"), lambda d: quality.scored(d, model).select("doc_id", "quality_pred"),
                lambda d: quality.scored(d, model, keep=["doc_id"]), lambda d: minhash_dedup.one_of_each(d).select("doc_id"),
                lambda d: minhash_dedup.near_duplicates(d), lambda d: pii.pseudonymise(d, "k").select("doc_id", "text"),
                lambda d: decontam.contaminated(d, items), lambda d: langid.identify(d, kinds), lambda d: infill.fill_in_middle(d),
                lambda d: importance.resample(d, items), lambda d: context_tree.score_documents(d, ids).select("doc_id", "n_known", F.round("score", 6))):
        assert sorted(map(str, run(wide).collect())) == sorted(map(str, run(plain).collect()))
    assert minhash_dedup.one_of_each(wide).columns == wide.columns == pii.pseudonymise(wide, "k").columns
