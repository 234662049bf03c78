"""A training-data pipeline of five stages over ``documents``, each with one operator.

quality classifier -> n-gram Jaccard join -> benchmark decontamination -> personal data -> pieces and back.
Every stage works on all that the one before kept; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from docweave.llm.common import table, vocabulary
from docweave.llm.decontaminate import decontaminate
from docweave.llm.jaccard_join import near_duplicates_removed
from docweave.llm.pii import redact
from docweave.llm.piece_codec import piece_digests
from docweave.llm.quality_classifier import fit_quality, rejected_removed
from docweave.workers import frugal, shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject."""
    frugal(spark)
    return rejected_removed(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest doc_id."""
    frugal(spark)
    return near_duplicates_removed(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    frugal(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    frugal(spark)
    return redact(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's piece ids, and digest of the text decoded from them."""
    frugal(spark)
    return piece_digests(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("quality_classifier", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", pieces),
]

#: SQL can express neither the machine's scores nor the merges of the vocabulary; tests compare the stages with
#: plain Python versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
