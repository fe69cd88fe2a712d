"""Corpus preparation: the stages that turn ``documents`` into training input.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame,
which is written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.llm import decontaminate, jaccard, pieces, pii, quality
from keepwell.session import scratch


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document, that of the smallest id, of each class of near copies."""
    return jaccard.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind; ``n_chars`` follows the text."""
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents with their piece ids; the text is what the pieces decode to."""
    return pieces.transcribe(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("SentencePiece encoding and decoding", encoding),
]

#: compression, similarity classes, segment models and merges have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each result is written once to the shared folder."""
    root = scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, folder).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
    return docs
