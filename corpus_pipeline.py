"""A training corpus from raw documents: five of the operators, one after the other.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the
last return the columns of ``documents``. Stages are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm.common import landed, table
from rollcall.llm.decontaminate import decontaminated
from rollcall.llm.packing import pack_documents
from rollcall.llm.queries import tokenizer_path
from rollcall.llm.secrets import secrets_redacted
from rollcall.llm.simhash import near_copies_removed
from rollcall.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labels of the folder."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return near_copies_removed(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the folder's benchmark go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by their kind; all documents stay."""
    return secrets_redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2048 tokens."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scan", secret_scan),
    ("best-fit packing", pack),
]

#: The stages fit models, decode texts and pack sequences, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = landed(docs, "stage")
    return docs
