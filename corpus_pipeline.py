"""Corpus pipeline: five stages, each on all that the one before kept.

1. toxicity: documents that the classifier rejects go;
2. near-duplicates: one document of each SimHash group stays;
3. decontamination: documents with benchmark passages go;
4. secrets: credential values but widely copied examples are replaced in the texts;
5. byte-level BPE: every text becomes token ids, with offsets to decode them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tracelode.llm.byte_bpe import encode_texts
from tracelode.llm.common import cut, table
from tracelode.llm.decontaminate import decontaminated
from tracelode.llm.secret_scan import redacted
from tracelode.llm.simhash_dedup import deduplicated
from tracelode.llm.toxicity import clean_documents


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on `labels`, scores below its threshold. Null and empty texts get
    the model's bias; an empty table gives an empty one."""
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id; null ids stay only where their group
    has no other."""
    return deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without enough words of `benchmark` passages to count as contaminated."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with credential values but widely copied examples replaced; n_chars follows the text."""
    return redacted(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as token ids with offsets, and hashes of the ids and of the text decoded from them."""
    return encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("byte_bpe", encoding_stage),
]

#: Classifier, fingerprints and tokens are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
