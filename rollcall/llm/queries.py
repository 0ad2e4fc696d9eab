"""The operators as registered queries, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import decontaminate, licenses, line_dedup, lm_score, packing, pii, quality_rules, ranked_search, secrets, simhash, token_align, toxicity, warc
from rollcall.llm.common import shared_path, table
from rollcall.llm.oracle import ORACLE as ORACLE


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file; every executor must have it there."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rated = quality_rules.verdicts(quality_rules.ledger(table(spark, folder, "documents")))
    return rated.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed"
    )


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"
    )


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


def op5_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.pseudo_likelihood(table(spark, folder, "documents"))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_digests(table(spark, folder, "documents"))


def document_files(documents: DataFrame) -> DataFrame:
    """Documents as files of a tree by source, language and id.

    Those that speak of a licence are licence files of their block of 256 ids, the others lie in
    folders of 16 ids below it.
    """
    block = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 256))
    speaks = F.coalesce(F.col("text").rlike("(?i)licen[cs]e"), F.lit(False))
    name = F.when(speaks, F.lit("LICENSE")).otherwise(F.concat_ws("/", F.floor(F.col("doc_id") / 16), F.lit("text")))
    return documents.select(
        F.col("doc_id").alias("row"), F.concat(block, F.lit("/"), name, F.lit("-"), "doc_id").alias("path"), "text"
    )


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    files = document_files(table(spark, folder, "documents"))
    return licenses.file_licences(files).withColumnRenamed("row", "doc_id")


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_components(table(spark, folder, "documents"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data_digests(table(spark, folder, "documents"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return token_align.alignment_scores(documents, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op3_warc": op3_warc,
    "op4_packing": op4_packing,
    "op5_lm_score": op5_lm_score,
    "op6_secrets": op6_secrets,
    "op7_licenses": op7_licenses,
    "op8_simhash": op8_simhash,
    "op9_pii": op9_pii,
    "op10_decontamination": op10_decontamination,
    "op11_ranked_search": op11_ranked_search,
    "op12_token_alignment": op12_token_alignment,
    "op13_line_dedup": op13_line_dedup,
}
