"""Exact top-k inner products by MaxScore over shards of the candidates.

Dimensions are the terms of a query. Within a shard, what a dimension can add to a score lies between a lowest and a
highest value; scores are counted from the sum of the lowest, so that every term adds at least 0 and at most its bound.
Terms whose bounds together stay below the k-th best score so far are non-essential: no vector gets in by them alone.
The essential terms' postings are traversed; the others are probed, largest bound first, only for vectors that can still
reach the k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HITS = "query_id long, _query long, vec_id long, score long"


def max_score(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int,
              low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows of ``vectors`` (one row per dimension) by inner product, ties to smaller ids.

    ``ids`` ascend; rows with the id ``own`` take no part. ``low`` and ``high`` bound each dimension's values.
    """
    worst = np.minimum(query * low, query * high)
    bound = np.maximum(query * low, query * high) - worst
    base = worst.sum()
    order = np.argsort(bound, kind="stable")
    best_ids, best = np.empty(0, ids.dtype), np.empty(0)
    # the first rows give a threshold for the others
    for at, upto in ((0, min(len(ids), 16 * k)), (min(len(ids), 16 * k), len(ids))):
        rows = np.arange(at, upto)[ids[at:upto] != own]
        threshold = best[-1] - base if len(best) == k else -1.0
        together = np.cumsum(bound[order])
        n_other = int(np.searchsorted(together, threshold, side="left")) if threshold > 0 else 0
        essential, others = order[n_other:], order[:n_other][::-1]
        got = query[essential] @ vectors[essential][:, rows] - worst[essential].sum()
        rest = together[n_other - 1] if n_other else 0.0
        for d in np.array_split(others, max(1, len(others) // 4)):
            alive = got + rest >= threshold
            rows, got = rows[alive], got[alive]
            if not len(rows) or not len(d):
                break
            got = got + query[d] @ vectors[d][:, rows] - worst[d].sum()
            rest -= bound[d].sum()
        all_ids, all_scores = np.concatenate([best_ids, ids[rows]]), np.concatenate([best, got + base])
        first = np.lexsort((all_ids, -all_scores))[:k]
        best_ids, best = all_ids[first], all_scores[first]
    return best_ids, best


def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``vec_id`` and ``v``: each component x as floor(scale * x). Rows that have no id or vector, or a null or
    non-finite component, take no part."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & (F.abs(e) < float("inf")) & ~F.isnan(e))
    return vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(scale * e)).alias("v")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` numbers, short ones filled up with 0."""
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = values[ends[0] : ends[-1]]
    return out


def _whole(column: pa.Array, width: int) -> np.ndarray:
    """As ``_matrix``, in whole numbers."""
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = values[ends[0] : ends[-1]]
    return out


def exact_scores(vectors: np.ndarray, query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whole scores of the rows of ``vectors``, of any size that a long holds; fails if that of one of ``others`` is beyond.

    Sums may leave the longs on the way: they come back with the last term.
    """
    with np.errstate(over="ignore"):
        scores = vectors @ query
    near = np.abs(vectors.astype(float)) @ np.abs(query.astype(float)) >= 2.0**62
    for row in np.flatnonzero(near & others):
        if scores[row] != sum(a * b for a, b in zip(vectors[row].tolist(), query.tolist(), strict=True)):
            raise ValueError("a score is beyond the longs")
    return scores


def _search(k: int):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "_query": [], "vec_id": [], "score": []}
        schema = pa.schema([(name, pa.int64()) for name in out])
        if not len(candidates) or not len(queries):
            return schema.empty_table()
        c, q = candidates.combine_chunks().sort_by("vec_id"), queries.combine_chunks()
        columns = [t.column("v").combine_chunks() for t in (c, q)]
        width = max(int(np.diff(x.offsets.to_numpy()).max()) for x in columns)
        x, y = (_matrix(v, width) for v in columns)
        if width * (np.abs(x).max(initial=0) + 1) * (np.abs(y).max(initial=0) + 1) >= 2.0**53:
            x, y = (_whole(v, width) for v in columns)
            ids = c.column("vec_id").to_numpy()
            for own, number, query in zip(q.column("vec_id").to_numpy(), q.column("_query").to_numpy(), y, strict=True):
                scores, rows = exact_scores(x, query, ids != own), np.flatnonzero(ids != own)
                rows = rows[np.lexsort((ids[rows], ~scores[rows]))[:k]]  # ~ turns the order of all longs round
                out["query_id"] += [own] * len(rows)
                out["_query"] += [number] * len(rows)
                out["vec_id"] += ids[rows].tolist()
                out["score"] += scores[rows].tolist()
            return pa.table(out, schema=schema)
        x = np.ascontiguousarray(x.T)
        ids, low, high = c.column("vec_id").to_numpy(), x.min(axis=1), x.max(axis=1)
        for own, number, query in zip(q.column("vec_id").to_numpy(), q.column("_query").to_numpy(), y, strict=True):
            found, scores = max_score(x, ids, query, own, k, low, high)
            out["query_id"] += [own] * len(found)
            out["_query"] += [number] * len(found)
            out["vec_id"] += found.tolist()
            out["score"] += scores.astype(np.int64).tolist()
        return pa.table(out, schema=schema)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, per_shard: int = 4096, per_block: int = 1024) -> DataFrame:
    """The k best candidates of each query: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Both inputs have ``vec_id`` and ``v`` (whole numbers; the shorter of two vectors counts as filled with 0). A
    candidate with the query's own id takes no part. Equal scores go to the smaller id. Repeated candidates count each;
    repeated queries are answered once. With fewer candidates all are given; empty tables give none. Groups whose
    scores might reach 2**53 are scored in full in whole numbers; the job fails if a score is beyond the longs.

    Shards have about ``per_shard`` candidates by a hash of the id, blocks about ``per_block`` queries; each pair of a
    shard and a block is one group, and only its k best rows per query are merged.
    """
    n, n_queries = vectors.count(), queries.count()
    shards, blocks = max(1, -(-n // per_shard)), max(1, -(-n_queries // per_block))

    def numbers(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    c = vectors.select(
        "vec_id", "v", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"),
        numbers(blocks).alias("block"),
    )
    q = queries.dropDuplicates(["vec_id", "v"]).withColumn("_query", F.xxhash64("v")).select(
        "vec_id", "v", "_query", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int").alias("block"),
        numbers(shards).alias("shard"),
    )
    hits = c.groupBy("shard", "block").cogroup(q.groupBy("shard", "block")).applyInArrow(_search(k), HITS)
    best = Window.partitionBy("query_id", "_query").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
