"""From raw documents to a training mix: quality, near-duplicates, benchmark
decontamination, personal data, and source weights.

Every stage takes all documents that the one before kept; all but the last return
the columns of ``documents``. Further columns pass through, whatever their names; the
last adds ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import decontam, minhash_dedup, mixing, pii, quality
from ledgerlight.llm.common import apart, reach_workers, table, written

#: A stage rejects below a plain majority of the weighted votes: clean documents near the border stay.
KEEP_SCORE = 0.5


@apart
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    reach_workers(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), F.lit(True))
    scored = quality.scored(docs, model, KEEP_SCORE)
    return scored.where("quality_pred = 1").select(*docs.columns)


@apart
def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group (5-word shingles, similarity 0.8)."""
    reach_workers(spark)
    return minhash_dedup.one_of_each(docs, 5, (8, 10))


@apart
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    reach_workers(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


@apart
def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and secrets replaced; n_chars follows the text."""
    reach_workers(spark)
    out = pii.pseudonymise(docs, pii.session_key(spark))
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


@apart
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how often (mix_copies)."""
    reach_workers(spark)
    return mixing.mix_sources(docs).where("mix_copies > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_benchmark),
    ("personal_data", replace_personal_data),
    ("mixing", mix),
]

#: SQL expresses none of the learned and hashed stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
