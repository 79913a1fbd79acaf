"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination,
personal data, byte-level BPE.

Each stage takes the documents its predecessor kept (written as Parquet and read again)
and returns documents with the same columns; the last one returns the encoded corpus.
Decisions take effect: rejected documents, all but one of each near-duplicate class,
and contaminated documents are gone, and personal data is masked in the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm.common import materialize, table
from riskframe.llm.op2_neardup import drop_near_duplicates
from riskframe.llm.op3_bpe import encode_documents
from riskframe.llm.op5_pii import sanitise
from riskframe.llm.op7_decontam import drop_contaminated
from riskframe.llm.op8_quality import filter_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return filter_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any item of ``benchmark``."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return sanitise(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of each document's ids and decoded bytes."""
    return encode_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

#: Estimates, sampling and the merge loop have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
