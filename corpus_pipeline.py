"""From documents to token ids: five stages, each written and read again by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.llm.lines import dedup_lines
from lakestrata.llm.mixing import poisson_mix
from lakestrata.llm.queries_native import MIX_OTHER, MIX_SEED, MIX_WEIGHTS
from lakestrata.llm.queries_text import token_digests
from lakestrata.llm.repetition import keep_clean
from lakestrata.llm.simhash import keep_one
from lakestrata.sources.folders import delete_folder
from lakestrata.sources.scratch import scratch_dropped, scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the suffix-array rule accept."""
    return keep_clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the repeated lines; `n_chars`, where there is one, counts what stays."""
    kept = dedup_lines(docs).select(*(F.col(f"`{c}`") for c in docs.columns))
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return keep_one(docs, shingle=4, most=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the target weights of their sources, in random order."""
    mixed = poisson_mix(docs, MIX_WEIGHTS, other=MIX_OTHER, seed=MIX_SEED)
    return mixed.select(*(F.col(f"`{c}`") for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of each copy's token ids."""
    return token_digests(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("mixing to weights", mix),
    ("byte-level BPE", encode),
]

# Suffix arrays, SimHash components and BPE are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over `documents`.

    A stage's intermediate tables go once its result is written, and that one when the next stage's is.
    """
    docs, before = spark.read.parquet(f"{str(sf_dir).rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "_"))
        with scratch_dropped(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before is not None:
            delete_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
