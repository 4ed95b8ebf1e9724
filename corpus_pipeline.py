"""From raw documents to packed sequences: quality rules, near-duplicates, repeated passages, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetra.llm import neardups, packing, pii, quality, substrings
from lumetra.llm.asking import forget, kept
from lumetra.llm.vocabularies import vocabulary


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        docs = docs.withColumn("n_chars", F.char_length("text").cast(kind))
    return docs.select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of policy v1 rejects."""
    return quality.apply_policy(quality.ledger(docs), "v1").where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 per cent of common five-word shingles."""
    return neardups.keep_one(docs, size=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 13-word windows that a document of smaller id holds."""
    return _measured(substrings.remove(docs, k=13), docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _measured(pii.redact(docs), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' tokens in sequences of 2048."""
    path, special = vocabulary("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256}
    return packing.pack_documents(docs, path, special, end_id=0, capacity=2048)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("personal data", personal_data),
    ("packing", packing_stage),
]

#: Components, boosted trees and best fit are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if i:  # a stage's output goes when the next one's is stored
            forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
