"""A training corpus from raw documents: five stages, each on all that the one before kept.

Every stage's result is written as Parquet and read again. All but the last return
the columns of documents; the last returns the digests of the encoded texts.

Defined results: a document without a score or doc_id is kept by the filters (they
take out what they found, nothing else); of documents that are near duplicates the
one with the smallest doc_id stays; rows that repeat a doc_id share its fate.
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starq.llm import bpe, decontaminate, jaccard, pii, quality
from starq.llm.common import Scratch, read
from starq.llm.queries import PII_KEY


def _without(docs: DataFrame, doc_ids: DataFrame) -> DataFrame:
    """docs but for these doc_ids; the keys' size decides how they are joined."""
    return docs.join(doc_ids.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out documents that the classifier rejects."""
    scored = quality.score(docs, read(spark, sf_dir, "labels"))
    return _without(docs, scored.where("predicted = 0"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of every group of near duplicates."""
    return _without(docs, jaccard.near_duplicates(docs).where("component_id <> doc_id"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out documents that quote a benchmark item."""
    return _without(docs, decontaminate.quotations(docs, read(spark, sf_dir, "benchmark")))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by surrogates."""
    return pii.replace_entities(docs, PII_KEY)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes the texts and decodes them again."""
    return bpe.encode(docs, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("tokens", tokens_stage),
]

#: A learnt classifier, edit distances and merges are not SQL: tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        scratch.keep(name)
    return docs
