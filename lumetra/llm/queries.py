"""The registered queries over the operators, each on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetra.llm import align, bpe, html, lm, neardups, negatives, packing, pii, quality, substrings, topk, toxicity, warc
from lumetra.llm.vocabularies import vocabulary
from lumetra.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans"
    )


@query
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardups.classes(_table(spark, sf_dir, "documents"), size=4, percent=80)


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.apply_policy(quality.ledger(docs), "v1")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(quality.mask("base"))) != 0).alias("base_failed"), "kept",
    )


@query
def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(_table(spark, sf_dir, "documents"), k=13)


@query
def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"))


@query
def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_numbers(_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, special = vocabulary("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256}
    return packing.pack_documents(_table(spark, sf_dir, "documents"), path, special, end_id=0, capacity=2048)


@query
def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


@query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = scratch_path(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), archive)
    return warc.read(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = map(vocabulary, ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.align(_table(spark, sf_dir, "documents"), *files)


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    rows = negatives.prepared(_table(spark, sf_dir, "embeddings"), label=label)
    return negatives.mine(rows, rows.where("vec_id % 100 = 0"))
