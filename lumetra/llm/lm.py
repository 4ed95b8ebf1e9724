"""Language-model scores by deleted interpolation.

The probability of a token mixes the maximum-likelihood estimates of word pairs, of words and of an unseen word. The
weights depend on how often the context was seen, by powers of two, and are learned by expectation-maximisation on
documents that the estimates leave out (Jelinek and Mercer, 1980), with their estimates rounded to quarter octaves, so that
the table they are learned from does not grow with the corpus. The final estimates use all training documents, unrounded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetra.llm.asking import Batch, Questions, answer, ask, batches, bucket_count, mix, per_row, told, total
from lumetra.llm.common import id_and_text

TEST, LEARN, WEIGH = 0, 1, 2  # folds: never learned from; counted; counted, and used to learn the weights
WORD, PAIR = 0, 1
CONTEXTS = 40  # a context seen c times is in bucket bit_length(c)
STEPS = 4  # levels per octave in the table of estimates
START = np.uint64(0x9E3779B97F4A7C15)  # the context of a first token
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _pairs(b: Batch) -> np.ndarray:
    """The key of (word before, word) for each token."""
    words = b.words
    before = np.roll(words, 1)
    before[b.starts[:-1]] = START
    return mix(before * np.uint64(0xD1342543DE82EF95) + mix(words))


def _questions(b: Batch) -> Questions:
    """Each distinct word and word pair of a batch, with its count in it. The fold says which count it is."""
    out = []
    for kind, tokens in ((WORD, b.words), (PAIR, _pairs(b))):
        keys, counts = np.unique(tokens, return_counts=True)
        none = np.zeros(len(keys), np.uint64)
        counts = counts.astype(np.uint64)
        out.append((kind, keys, [counts if b.fold != TEST else none, counts if b.fold == WEIGH else none]))
    return out


def _sums(kind: int, which: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    n = int(which.max(initial=-1)) + 1
    return [np.bincount(which, weights=v, minlength=n).astype(np.uint64) for v in values]


def _counts(b: Batch, answers: list[dict], buckets: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per token: counts of the word, and of the pair; each in all training documents and in the weighing ones."""
    out = []
    for kind, tokens in ((WORD, b.words), (PAIR, _pairs(b))):
        keys, which = np.unique(tokens, return_inverse=True)
        out.append([t[which].astype(np.float64) for t in told(answers, kind, keys, buckets, 2)])
    return out[0], out[1]


def _context(b: Batch, words: np.ndarray, documents: int) -> np.ndarray:
    """How often what stands before each token was seen."""
    before = np.roll(words, 1)
    before[b.starts[:-1]] = documents
    return before


def _level(p: np.ndarray) -> np.ndarray:
    """A small number for a probability; 1 stands for zero."""
    return np.where(p > 0, np.round(STEPS * np.log2(np.maximum(p, 1e-30))), 1).astype(np.int64)


def _bucket(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))) + 1, 0), CONTEXTS - 1).astype(np.int64)


def learn_weights(table: list[tuple[int, int, int, float]], unseen: float, rounds: int = 60) -> np.ndarray:
    """Weights (pair, word, unseen) by context bucket, from (bucket, level of the pair's estimate, level of the word's,
    tokens). Buckets without tokens take the pooled weights; a context never seen gives its pair no weight."""
    weights = np.tile([0.4, 0.5, 0.1], (CONTEXTS, 1))
    if not table:
        return weights
    rows = np.array(table, np.float64)
    level = lambda x: np.where(x > 0, 0.0, 2.0 ** (np.minimum(x, 0) / STEPS))
    p = np.stack([level(rows[:, 1]), level(rows[:, 2]), np.full(len(rows), unseen)], axis=1)

    def em(which: np.ndarray, w: np.ndarray) -> np.ndarray:
        for _ in range(rounds):
            part = w[which] * p
            part *= (rows[:, 3] / part.sum(axis=1))[:, None]
            sums = np.stack([np.bincount(which, weights=part[:, j], minlength=len(w)) for j in range(3)], axis=1)
            filled = sums.sum(axis=1) > 0
            w = w.copy()
            w[filled] = (sums[filled] + 1e-6) / (sums[filled] + 1e-6).sum(axis=1, keepdims=True)
        return w

    pooled = em(np.zeros(len(rows), np.int64), weights[:1])
    return em(rows[:, 0].astype(np.int64), np.tile(pooled, (CONTEXTS, 1)))


def score(docs: DataFrame, weigh_one_in: int = 10) -> DataFrame:
    """Scores of every document (``SCORES``), by a model of those that are not held out.

    Words are lower-cased (A to Z); each document ends with a token of its own. Null and empty texts are that token alone.
    A null ``doc_id`` counts as not held out. Repeated rows are counted and scored each. One in ``weigh_one_in`` training
    documents, by a hash of the id, learns the weights. Without training documents every estimate is that of an unseen
    word. Other columns of ``docs`` are not read.
    """
    fold = F.when(held_out(), TEST).when(
        F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(weigh_one_in)) == 0, WEIGH
    ).otherwise(LEARN)
    rows = batches(
        id_and_text(docs).select("doc_id", fold.alias("fold"), F.lit(0).cast("long").alias("mark"), "text"),
        lower=True, end=True,
    )
    sums = {
        r["fold"]: (r["tokens"], r["documents"]) for r in rows.groupBy("fold").agg(
            F.sum("n_tokens").alias("tokens"), F.sum(F.size("docs")).alias("documents")
        ).collect()
    }
    buckets = bucket_count(rows, sum(t for t, _ in sums.values()))
    asks = ask(rows, Batch, _questions, buckets)
    answers = answer(asks, _sums)
    train = sum(sums.get(f, (0, 0))[0] for f in (LEARN, WEIGH))
    documents = sum(sums.get(f, (0, 0))[1] for f in (LEARN, WEIGH))
    rest, rest_documents = sums.get(LEARN, (0, 0))
    distinct = total(answers.where(F.col("kind") == WORD), "some")
    unseen = 1 / (distinct + 1)

    def estimates(row: dict, replies: list[dict]) -> pa.Table:
        b = Batch(row)
        words, pairs = _counts(b, replies, buckets)
        context = _context(b, words[0] - words[1], rest_documents)
        pair = np.where(context > 0, (pairs[0] - pairs[1]) / np.maximum(context, 1), 0)
        word = (words[0] - words[1]) / max(rest, 1)
        cells, n = np.unique(np.stack([_bucket(context), _level(pair), _level(word)], axis=1), axis=0, return_counts=True)
        return pa.table({"bucket": cells[:, 0], "pair": cells[:, 1], "word": cells[:, 2], "n": n.astype(np.int64)})

    weighing = per_row(
        rows.where(F.col("fold") == WEIGH), answers.where(F.shiftright("batch", 32).bitwiseAND(3) == WEIGH), estimates, "bucket long, pair long, word long, n long"
    ) if WEIGH in sums else None
    # the number of cells is bounded by the levels, not by the data
    table = [] if weighing is None else weighing.groupBy("bucket", "pair", "word").agg(F.sum("n")).orderBy(
        "bucket", "pair", "word").collect()
    weights = learn_weights([tuple(r) for r in table], unseen)

    def scores(row: dict, replies: list[dict]) -> pa.Table:
        b = Batch(row)
        words, pairs = _counts(b, replies, buckets)
        context = _context(b, words[0], documents)
        w = weights[_bucket(context)]
        p = w[:, 0] * np.where(context > 0, pairs[0] / np.maximum(context, 1), 0)
        p += w[:, 1] * words[0] / max(train, 1) + w[:, 2] * unseen
        base = np.log10((words[0] + 1) / (train + distinct + 1))
        by_doc = lambda x: np.add.reduceat(x, b.starts[:-1])  # noqa: E731  every document has a token
        n = len(b.docs)
        return pa.table({
            "doc_id": pa.array(b.docs, pa.int64()), "held_out": pa.array([b.fold == TEST] * n),
            "n_tokens": b.sizes, "n_known": by_doc((words[0] > 0).astype(np.int64)),
            "train_tokens": pa.array([train] * n, pa.int64()), "base_score": by_doc(base), "score": by_doc(np.log10(p)),
        })

    return per_row(rows, answers, scores, SCORES)
