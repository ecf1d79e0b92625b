"""Queries over whole texts that SQL cannot express; tests hold them against brute force."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.llm.bpe import encode_texts, share_vocabulary
from lakestrata.llm.lines import dedup_lines
from lakestrata.llm.registry import check, table
from lakestrata.llm.repetition import repetition_stats
from lakestrata.llm.simhash import simhash_classes
from lakestrata.llm.substrings import dedup_substrings
from lakestrata.llm.token_spans import section_tokens
from lakestrata.llm.vectors import vector_classes

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@check("op1_grid_order_join")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = vector_classes(table(spark, folder, "embeddings"), least=0.93)
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        "component_id",
        (F.col("id") == F.col("component_id")).alias("kept"),
    )


@check("op2_token_spans")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every line of every document."""
    return section_tokens(table(spark, folder, "documents"), RANKS, PATTERN)


@check("op5_suffix_repetition")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return repetition_stats(table(spark, folder, "documents"), carry=["doc_id"])


def token_digests(docs: DataFrame) -> DataFrame:
    """Per document: number of tokens, digest of the ids, digest of the bytes they decode to."""
    vocabulary = share_vocabulary(docs.sparkSession, RANKS)
    rows = docs.select("doc_id", "text")
    listed = F.concat_ws(" ", F.col("token_ids").cast("array<string>"))
    return encode_texts(rows, vocabulary, PATTERN, decoded_col="decoded").select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@check("op8_byte_bpe")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents"))


@check("op7_simhash_gray")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_classes(table(spark, folder, "documents"), shingle=4, most=4)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@check("op3_fuzzy_lines")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Per document its lines, those removed, and a digest of the text that stays."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@check("op10_fm_substring")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """A null text counts as one without words: its digest is that of the empty string."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = F.coalesce("text", F.lit(""))
    return dedup_substrings(docs, window=50).select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))
