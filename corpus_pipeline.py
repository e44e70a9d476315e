"""Training-text pipeline: five stages from ``documents`` to tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waymark.llm import bpe_lexicon, credentials, seed_align, signature_tree, toxic_cnn
from waymark.session import materialise


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    NULL texts count as empty; without examples of both labels nothing goes.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxic_cnn.without_toxic(docs, labels)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, 0.8).

    NULL and empty texts are linked with nothing and stay; of repeated rows one
    stays.
    """
    return signature_tree.one_per_component(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a test item go; NULL and empty texts hold none."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return seed_align.without_passages(docs, benchmark)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets and linked credential parts are blanked out; NULL texts stay NULL."""
    return credentials.redact_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, as tokens, decoded again; NULL texts have no tokens."""
    return bpe_lexicon.digests(bpe_lexicon.encode(docs))


STAGES = [
    ("toxicity", toxicity),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("encoding", encoding),
]

# The classifier, alignments and merges cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again.

    NULL ids stay NULL, further columns go through to the last stage, and an
    empty table gives an empty result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
