"""From raw documents to packed training sequences.

Stages, each over all that its predecessor kept: quality rules drop what they reject, near-duplicate
detection keeps one document of each group (five-word shingles, similarity of 0.8 or more),
decontamination drops documents that contain a benchmark item, packing places the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazlake.llm import decontaminate, neardup, packing, quality
from hazlake.llm.tokens import tokenizer_path
from hazlake.session import ARROW_BYTES, apply_conf, stage

TOKENIZER = "word_bpe_49k.json"
#: Bytes handed to a Python worker at once: by default up to 64 MB, which lie in the executor's JVM and in the worker.
BATCH_BYTES = packing.BATCH_BYTES


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.kept_documents(docs, language="lang")


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))
    return neardup.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The place of every piece of every document in a packed sequence."""
    return packing.pack(docs, tokenizer_path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Sketches and token ids are not SQL; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of ``folder``, each written and read again before the next."""
    docs = apply_conf(spark).read.parquet(f"{folder}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
