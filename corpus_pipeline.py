"""Corpus pipeline: documents through five stages of the training-data operators.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage
before kept; ``run`` writes each stage's result to the shared folder and reads
it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cardsentry.llm import decontaminate, near_dup, quality_rules, queries, repeats
from cardsentry.llm.shared import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, 80 %)."""
    return near_dup.drop_near_duplicates(docs, size=5, percent=80)


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that an earlier document has."""
    return repeats.cut_repeats(docs, 50)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, as counts and digests with those of the decoded bytes."""
    return queries.bpe_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_dedup),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: The stages' similarity search, alignment and tokenizer have no SQL form; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark, "pipeline") as s:
        for name, stage in STAGES:
            docs = s.stash(stage(spark, docs, sf_dir), name, keep=name == STAGES[-1][0])
    return docs
