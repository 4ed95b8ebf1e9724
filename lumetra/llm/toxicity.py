"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other texts count as unlabelled, since they may be toxic or not. With the
share ``prior`` of toxic texts, the risk on the unlabelled ones minus ``prior`` times the positives' risk as negatives
estimates the negatives' risk; where that estimate falls below zero the classifier is over-fitting, and the step goes
back up (Kiryo et al., 2017). The classifier is linear on the presence of hashed words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetra.llm.common import Memo, id_and_text, per_batch

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 20
MAX_POSITIVES = 4_000
MAX_UNLABELLED = 16_000
KEPT_FEATURES = 2_000


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # ascending hash buckets
    weights: np.ndarray
    bias: float


def bucket(word: str) -> int:
    return xxhash.xxh64_intdigest(word) % BUCKETS


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _hashed(docs: DataFrame) -> DataFrame:
    """The hash buckets of each text's words."""
    schema = pa.schema([("positive", pa.bool_()), ("buckets", pa.list_(pa.int32()))])

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word = Memo(bucket)

        def of(batch: pa.RecordBatch) -> dict:
            texts = batch.column("text").to_pylist()
            found = [sorted({of_word[w] for w in set(WORD.findall((t or "").lower()))}) for t in texts]
            return {"positive": batch.column("positive"), "buckets": found}

        return per_batch(of, schema)(batches)

    return docs.mapInArrow(start, "positive boolean, buckets array<int>")


def sample(docs: DataFrame, labels: DataFrame, max_positives: int, max_unlabelled: int, seed: int) -> tuple[DataFrame, float]:
    """Hashed training texts and the share of toxic ones among labelled documents, both without held-out ones.

    At most ``max_positives`` confirmed documents, and other documents at a rate that gives about ``max_unlabelled``;
    both are chosen by a hash of the id.
    """
    told = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = told.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    order = F.xxhash64("doc_id", F.lit(seed))
    chosen = told.where("toxic = 1").orderBy(order, "doc_id").limit(max_positives).select(
        F.col("doc_id").alias("_id"), F.lit(True).alias("_positive")
    )
    texts = id_and_text(docs).where(~held_out())
    least, every = -(2**63), 2**64
    upto = least + max_unlabelled * every // max(1, texts.count())  # of a hash other than that of the positives
    picked = F.xxhash64("doc_id", F.lit(seed + 1)) < F.lit(upto) if upto < least + every - 1 else F.lit(True)
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"), "left").where(
        F.col("_positive").isNotNull() | picked
    ).select(F.col("_positive").isNotNull().alias("positive"), "text", picked.alias("picked"))
    # a chosen positive that is also in the unlabelled sample belongs to both
    both = rows.withColumn("positive", F.explode(F.array_distinct(F.array(
        F.col("positive"), F.col("positive") & ~F.coalesce(F.col("picked"), F.lit(False))
    )))).select("positive", "text")
    return _hashed(both), toxic / n if n else 0.0


def _csr(rows: list[np.ndarray], kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the present features."""
    sizes = [len(r) for r in rows]
    row = np.repeat(np.arange(len(rows)), sizes)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    at = np.searchsorted(kept, flat)
    hit = (at < len(kept)) & (kept[np.minimum(at, len(kept) - 1)] == flat) if len(kept) else np.zeros(len(flat), bool)
    return row[hit], at[hit]


def train(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, features: int = KEPT_FEATURES,
          steps: int = 400, rate: float = 0.05, penalty: float = 1e-4) -> Model:
    """Logistic classifier with the non-negative positive-unlabelled risk, on the ``features`` words whose share among
    positives differs most clearly from that among the unlabelled."""
    if not positives or not unlabelled or not prior:
        return Model(np.empty(0, np.int64), np.empty(0), float(np.clip(np.log(max(prior, 1e-9) / max(1 - prior, 1e-9)), -20, 20)))
    share = [np.bincount(np.concatenate(x), minlength=BUCKETS) / len(x) for x in (positives, unlabelled)]
    mean = (share[0] + share[1]) / 2
    clear = np.abs(share[0] - share[1]) / np.sqrt(mean * (1 - mean) * (1 / len(positives) + 1 / len(unlabelled)) + 1e-9)
    clear[(share[0] * len(positives) < 3) & (share[1] * len(unlabelled) < 3)] = 0
    kept = np.sort(np.argsort(-clear, kind="stable")[:features])
    kept = kept[clear[kept] > 3]
    (rp, cp), (ru, cu) = _csr(positives, kept), _csr(unlabelled, kept)
    n_p, n_u, w, b = len(positives), len(unlabelled), np.zeros(len(kept)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)

    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    for step in range(1, steps + 1):
        zp = np.bincount(rp, weights=w[cp], minlength=n_p) + b
        zu = np.bincount(ru, weights=w[cu], minlength=n_u) + b
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp_neg, gu_neg = -prior * sigmoid(zp) / n_p, sigmoid(zu) / n_u
        if negative >= 0:
            gp, gu = gp_neg - prior * sigmoid(-zp) / n_p, gu_neg
        else:
            gp, gu = -gp_neg, -gu_neg
        g = np.append(np.bincount(cp, weights=gp[rp], minlength=len(kept)) + np.bincount(cu, weights=gu[ru], minlength=len(kept)), gp.sum() + gu.sum())
        g[:-1] += penalty * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return Model(kept.astype(np.int64), w, b)


def fit(docs: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED,
        seed: int = 7) -> Model:
    """Learns from a bounded sample of the documents that are not held out."""
    hashed, prior = sample(docs, labels, max_positives, max_unlabelled, seed)
    table = hashed.toArrow()
    rows = [np.asarray(x, np.int64) for x in table.column("buckets").to_pylist()]
    positive = table.column("positive").to_pylist()
    return train([r for r, p in zip(rows, positive, strict=True) if p],
                 [r for r, p in zip(rows, positive, strict=True) if not p], prior)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` from 0 to 1 and ``predicted`` of every text, one narrow pass.

    Null and empty texts get the score of a text without known words. Repeated rows are scored each. Other columns
    of ``docs`` are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    weights = {int(f): float(w) for f, w in zip(model.features, model.weights, strict=True)}
    bias = model.bias

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word = Memo(lambda w: (bucket(w), weights.get(bucket(w))))

        def margin(text: str) -> float:
            found = {x for x in map(of_word.__getitem__, set(WORD.findall(text.lower()))) if x[1] is not None}
            return bias + sum(w for _, w in sorted(found))

        def of(batch: pa.RecordBatch) -> dict:
            z = np.clip([margin(t or "") for t in batch.column("text").to_pylist()], -30, 30)
            return {"doc_id": batch.column("doc_id"), "score": 1 / (1 + np.exp(-z))}

        return per_batch(of, schema)(batches)

    scored = id_and_text(docs).mapInArrow(start, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
