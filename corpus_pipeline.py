"""From raw documents to token ids: five stages, each over all rows that its predecessor kept.

Each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftline.llm import bpe, decontaminate, jaccard, langid, quality
from driftline.llm.common import new_path
from driftline.llm.queries import vocabulary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no language that the models know go."""
    return langid.keep_named(docs, langid.fit(docs))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier scores under 0.5 go."""
    return quality.keep_good(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity of at least 0.8) the document with the smallest id stays."""
    return jaccard.keep_one(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, exact or edited, go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids)."""
    return bpe.encode_digests(docs, vocabulary(), with_ids=True)


STAGES = [("language_id", language_id), ("quality_classifier", quality_classifier), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("encoding", encoding)]

#: Learned models and alignments are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
