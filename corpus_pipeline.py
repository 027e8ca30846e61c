"""From raw documents to token ids: five stages, each on all that the one before kept.

A stage is a function of (spark, docs, sf_dir). ``run`` writes each one's rows as Parquet to
the shared folder and hands the reread table on. All but the last return the columns of
``documents``. What a stage read is deleted once its own rows are stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streakline.llm import bpe, mixing, pii, simhash, toxicity
from streakline.session import scratch_path, scratch_scope, stage_at


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model learns from the labels of ``sf_dir``. Null texts are scored as empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group linked by fingerprints.

    Fingerprints are of three-word shingles and link at 3 or fewer differing bits; null and empty
    texts share one fingerprint.
    """
    return simhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets; null texts stay null."""
    return pii.mask_personal_data(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole each time; null and empty texts weigh nothing."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens`` and digests of the ids and of the decoded text."""
    return bpe.measure_encoding(docs, keep=("doc_id", "source"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("source mix", mix_sources),
    ("byte-pair encoding", encode),
]

#: The stages train models and search trees, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, step in STAGES:
        path = scratch_path(spark, "stage")
        # A stage's own scratch tables go once its rows are stored, its input once they are.
        with scratch_scope(spark) as made:
            docs = stage_at(step(spark, docs, sf_dir), path)
            made += [before] if before else []
        before = path
    return docs
