"""Scores of factor vectors: best partners by dot product or cosine, without scoring all pairs.

Vectors are packed into blocks; a pair of blocks that may hold a hit is one group and one matrix product, of which only the
k best of each row leave the group. Two bounds decide which pairs of a vector and a block need not meet:

* Best items (``best_items``): no score exceeds the product of the norms. Items are banded by norm; users first meet the
  longest items, and from then on only bands in which an item could still beat their k-th best.
* Similar items (``similar_items``): items are grouped around pivots. Two unit vectors are no more than an angle apart only if
  each lies within that angle of the other's group, whose width around its pivot is known. Groups are dealt to a few large
  blocks; a pair of blocks scores each of its pairs once for both, in single precision first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumetra.operators.blocks import Best, best_of_rows, block_count
from lumetra.operators.topk import as_list, top_k
from lumetra.session import stored

LEFT_BLOCK = 8192
RIGHT_BLOCK = 2048
BAND_GROWTH = 2
SIMILAR_BLOCK, SIMILAR_CELLS = 65_536, 4_000_000  # vectors, and numbers, of a block of similar items
SIMILAR_CHUNK = 1024
PIVOTS, PIVOT_SAMPLE = 64, 2048
_CHUNK_SCORES = 1024 * RIGHT_BLOCK
_SLACK = 1e-9
_BEST = "id bigint, other bigint, score double"


def _dot(f: Column, g: Column) -> Column:
    return F.aggregate(F.zip_with(f, g, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _plain(vectors: DataFrame, *more: str) -> DataFrame:
    return vectors.select(F.col("id").cast("bigint").alias("id"), F.col("features").cast("array<double>").alias("features"), *more)


def _normed(vectors: DataFrame) -> DataFrame:
    """Vectors with their length. Zero vectors have no cosine and are left out."""
    f = F.col("features")
    return vectors.select("id", "features", F.sqrt(_dot(f, f)).alias("norm")).filter(F.col("norm") > 0)


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """Vectors of length one. Zero vectors have no cosine and are left out."""
    return _normed(vectors).select("id", F.transform("features", lambda x: x / F.col("norm")).alias("features"))


def _block_kernel(k: int, min_score: float | None, strict: bool, exclude_same: bool):
    def matrix(t: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
        cells = t.column(column).combine_chunks().flatten()
        ids, features = cells.field("id").to_numpy(zero_copy_only=False), cells.field("features")
        return ids, features.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if left.num_rows and right.num_rows:
            a, fa = matrix(left, "cells")
            b, fb = matrix(right, "r_cells")
            by_id = np.argsort(b)
            b, fb = b[by_id], fb[by_id]
            chunk = max(16, _CHUNK_SCORES // max(1, len(b)))
            for start in range(0, len(a), chunk):
                rows = slice(start, start + chunk)
                score = np.round(fa[rows] @ fb.T, 12)
                if exclude_same:
                    score[a[rows, None] == b[None, :]] = -np.inf
                if min_score is not None:
                    score[(score <= min_score) if strict else (score < min_score)] = -np.inf
                i, j = np.nonzero(best_of_rows(score, k))
                found.append((a[rows][i], b[j], score[i, j]))
        ids, others, scores = (np.concatenate(c) for c in zip(*found))
        return pa.table({"id": ids, "other": others, "score": scores})

    return kernel


def _hashed(n: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")


def _packed(vectors: DataFrame, *keys: str) -> DataFrame:
    """One row per block. ``keys`` bound its size."""
    return vectors.groupBy(*keys).agg(F.collect_list(F.struct("id", "features")).alias("cells"))


def _every(n: int | Column) -> Column:
    return F.explode(F.sequence(F.lit(0), (F.lit(n) if isinstance(n, int) else n) - 1))


def _meet(left: DataFrame, right: DataFrame, kernel) -> DataFrame:
    """``kernel`` of the packed blocks (``lb``, ``rb``, ``cells``) with the same numbers."""
    named = right.select(F.col("lb").alias("r_lb"), F.col("rb").alias("r_rb"), F.col("cells").alias("r_cells"))
    return left.select("lb", "rb", "cells").groupBy("lb", "rb").cogroup(named.groupBy("r_lb", "r_rb")).applyInArrow(kernel, _BEST)


def best_partners(
    left: DataFrame, right: DataFrame, k: int, min_score: float | None = None, strict: bool = False,
    exclude_same: bool = False, blocks: tuple[int, int] | None = None,
) -> DataFrame:
    """``(id, other, score)``: the k right vectors of highest dot product for each left vector, by scoring all pairs.

    Scores are rounded to 12 places and ties go to the smaller id. Inputs are ``(id, features)``.
    """
    if blocks is None:
        parallelism = left.sparkSession.sparkContext.defaultParallelism
        blocks = (
            block_count(left.count(), LEFT_BLOCK, 128, parallelism),
            block_count(right.count(), RIGHT_BLOCK, 128, parallelism),
        )
    lt = _packed(_plain(left, _hashed(blocks[0]).alias("lb")), "lb").withColumn("rb", _every(blocks[1]))
    rt = _packed(_plain(right, _hashed(blocks[1]).alias("rb")), "rb").withColumn("lb", _every(blocks[0]))
    partial = _meet(lt, rt, _block_kernel(k, min_score, strict, exclude_same))
    return partial if blocks[1] == 1 else _top(partial, k)


def _top(scored: DataFrame, k: int) -> DataFrame:
    return top_k(scored, ["id"], [F.desc("score"), F.asc("other")], k)


# ---- best items ----


def norm_bands(items: DataFrame, first: int = RIGHT_BLOCK) -> tuple[DataFrame, list[dict]]:
    """Items with their band by norm, stored, and the bands: the longest ``first`` items, then twice as many each.

    The borders are approximate quantiles; a band's largest norm and size are exact. There are about log2(items / first) bands.
    """
    normed = stored(_plain(items).withColumn("norm", F.sqrt(_dot(F.col("features"), F.col("features")))), "items")
    n = normed.count()
    shares, size = [], first
    while size < n:
        shares.append(1 - size / n)
        size *= BAND_GROWTH
    borders = normed.agg(F.percentile_approx("norm", F.array([F.lit(s) for s in shares]), 10_000)).first()[0] if shares else []
    band = sum((F.when(F.col("norm") < b, 1).otherwise(0) for b in borders), F.lit(0)).cast("int")
    banded = normed.withColumn("band", band)
    rows = banded.groupBy("band").agg(F.max("norm").alias("longest"), F.count(F.lit(1)).alias("n")).orderBy("band").collect()
    return banded, [r.asDict() | {"parts": max(1, math.ceil(r["n"] / RIGHT_BLOCK))} for r in rows]


def best_items(users: DataFrame, items: DataFrame, k: int = 10, first: int = RIGHT_BLOCK) -> DataFrame:
    """``(id, other, score)``: up to k items of positive score for each user; seen items stay in.

    Users meet the band of the longest items, which gives each a k-th best score, and then those bands whose longest item
    could reach it by the product of the norms. The lists are those of scoring all pairs, which is done if there is one band.
    """
    if items.count() <= first:
        return best_partners(users, items, k, min_score=0.0, strict=True)
    return _top(_best_items(users, items, k, first)[0], k)


def scored_pairs(users: DataFrame, items: DataFrame, k: int = 10, first: int = RIGHT_BLOCK) -> DataFrame:
    """One row: ``n_pairs`` of users and items, and ``n_scored``, those that ``best_items`` scores."""
    _, met, n_users, bands = _best_items(users, items, k, first)
    n_items = sum(b["n"] for b in bands)
    size = F.element_at(F.array([F.lit(b["n"]) for b in bands] or [F.lit(0)]), F.col("band") + 1)
    return met.agg(F.lit(n_users * n_items).alias("n_pairs"), F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("n_scored"))


def _best_items(users: DataFrame, items: DataFrame, k: int, first: int) -> tuple[DataFrame, DataFrame, int, list[dict]]:
    """Candidates for the lists, which user met which band (numbered from 0), the number of users, the bands."""
    banded, bands = norm_bands(items, first)
    numbers = {b["band"]: i for i, b in enumerate(bands)}
    number = F.lit(-1)
    for b, i in numbers.items():
        number = F.when(F.col("band") == b, i).otherwise(number)
    banded = banded.withColumn("band", number.cast("int"))
    asking = stored(_plain(users).withColumn("norm", F.sqrt(_dot(F.col("features"), F.col("features")))), "users")
    n_users = asking.count()
    parallelism = users.sparkSession.sparkContext.defaultParallelism
    blocks = block_count(n_users, LEFT_BLOCK, 128, parallelism)
    kernel = _block_kernel(k, 0.0, True, False)
    # parts of all bands are numbered in a row
    starts = np.cumsum([0, *(b["parts"] for b in bands)]).tolist()
    parts = F.array([F.lit(b["parts"]) for b in bands] or [F.lit(1)])
    begin = F.array([F.lit(s) for s in starts])
    rb = F.element_at(begin, F.col("band") + 1) + F.pmod(F.xxhash64("id"), F.element_at(parts, F.col("band") + 1)).cast("int")
    right = _packed(banded.withColumn("rb", rb), "rb").withColumn("lb", _every(blocks))

    def search(met: DataFrame) -> DataFrame:
        """``met``: users (id, features) with a ``band`` to search."""
        left = _packed(met.withColumn("lb", _hashed(blocks)), "lb", "band")
        begins, n = F.element_at(begin, F.col("band") + 1), F.element_at(parts, F.col("band") + 1)
        return _meet(left.withColumn("rb", F.explode(F.sequence(begins, begins + n - 1))), right, kernel)

    met = asking.withColumn("band", F.lit(0))
    if not bands:
        return search(met), met.select("id", "band"), n_users, bands
    found = stored(_top(search(met), k), "found")
    if len(bands) == 1:
        return found, met.select("id", "band"), n_users, bands
    kth = found.groupBy("id").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).select("id", "kth")
    longest = F.array([F.lit(b["longest"]) for b in bands])
    reach = F.col("norm") * (1 + _SLACK) * F.element_at(longest, F.col("band") + 1) + F.lit(_SLACK)
    more = (
        asking.join(kth, "id", "left").withColumn("band", F.explode(F.sequence(F.lit(1), F.lit(len(bands) - 1))))
        .where((F.col("norm") > 0) & (reach >= F.coalesce("kth", F.lit(0.0)))).select("id", "features", "band")
    )
    all_met = met.select("id", "band").unionByName(more.select("id", "band"))
    return found.unionByName(search(more)), all_met, n_users, bands


# ---- similar items ----


def pivots(unit: DataFrame, n: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> np.ndarray:
    """Up to ``n`` directions out of at most ``sample`` vectors (those of smallest hash), each the farthest from those
    before it. They decide how much is pruned, not what is found."""
    rows = [r["features"] for r in unit.orderBy(F.xxhash64("id"), "id").limit(sample).select("features").collect()]
    x = np.array(rows, np.float64).reshape(len(rows), -1)
    chosen, nearest = ([0] if len(x) else []), np.full(len(x), -2.0)
    while chosen and len(chosen) < min(n, len(x)):
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
        far = int(np.argmin(nearest))
        if nearest[far] > 1 - 1e-9:
            break
        chosen.append(far)
    return x[chosen]


def _stored_lengths(vectors: DataFrame) -> DataFrame:
    """Vectors with their length, stored; in single precision if that holds all their numbers."""
    normed = _normed(_plain(vectors))
    single = normed.agg(F.bool_and(F.forall("features", lambda x: x.cast("float").cast("double") == x))).first()[0]
    return stored(normed.withColumn("features", F.col("features").cast("array<float>")) if single else normed, "lengths")


def _units(features: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return features.reshape(len(norms), -1).astype(np.float64) / norms[:, None]


def _grouped(normed: DataFrame, around: np.ndarray) -> DataFrame:
    """Vectors with the pivot they are nearest to (``home``) and their angles to all pivots, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _units(batch.column("features").flatten().to_numpy(zero_copy_only=False), batch.column("norm").to_numpy(zero_copy_only=False))
            angles = np.arccos(np.clip(x @ around.T, -1, 1)).astype(np.float32)
            home = pa.array(angles.argmin(axis=1).astype(np.int32))
            listed = pa.ListArray.from_arrays(np.arange(0, angles.size + 1, len(around), dtype=np.int32), angles.reshape(-1))
            yield pa.RecordBatch.from_arrays([*batch.columns, home, listed], names=[*batch.schema.names, "home", "angles"])

    schema = ", ".join(f"{name} {kind}" for name, kind in normed.dtypes)
    return stored(normed.mapInArrow(run, f"{schema}, home int, angles array<float>"), "grouped")


def _visits(normed: DataFrame, min_similarity: float, n_pivots: int) -> tuple[DataFrame, list[dict]]:
    """Grouped vectors, each with the groups (``visits``) that may hold one similar enough, and the groups."""
    unit = normed.select("id", F.transform("features", lambda x: x.cast("double") / F.col("norm")).alias("features"))
    grouped = _grouped(normed, pivots(unit, n_pivots))
    own = F.element_at("angles", F.col("home") + 1)
    # at most one row per pivot
    groups = [r.asDict() for r in grouped.groupBy("home").agg(F.max(own).alias("width"), F.count(F.lit(1)).alias("n")).orderBy("home").collect()]
    # rounded angles are off by less than a part of the margin
    apart = math.acos(max(-1.0, min(1.0, min_similarity))) + 2e-6
    near = F.array([
        F.when(F.element_at("angles", g["home"] + 1).cast("double") <= g["width"] + apart, F.lit(i)) for i, g in enumerate(groups)
    ] or [F.lit(None).cast("int")])
    return grouped.withColumn("visits", F.array_compact(near)).drop("angles"), groups


def _similar_kernel(k: int, min_similarity: float):
    """The best partners in either block of each vector of the other, or within one block."""

    def side(t: pa.Table, column: str):
        cells = t.column(column).combine_chunks().flatten()
        ids, norms, home, visits = (cells.field(f).to_numpy(zero_copy_only=False) for f in ("id", "norm", "home", "visits"))
        order = np.lexsort((ids, home))
        x = _units(cells.field("features").flatten().to_numpy(zero_copy_only=False), norms)[order]
        ids, home, visits = ids[order], home[order], visits[order]
        starts = np.flatnonzero(np.diff(home, prepend=-1))
        chunks = [
            slice(i, min(i + SIMILAR_CHUNK, end)) for start, end in zip(starts, [*starts[1:], len(ids)]) for i in range(start, end, SIMILAR_CHUNK)
        ]
        return ids, x, x.astype(np.float32), home, visits, chunks, [Best(c.stop - c.start, k) for c in chunks]

    def meeting(chunk: slice, visits: np.ndarray, group: int) -> np.ndarray:
        return np.flatnonzero(visits[chunk] >> np.int64(group % 64) & 1)

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        once = left.num_rows > 0 and left["lb"][0] == left["rb"][0]
        if left.num_rows and (once or right.num_rows):
            one = side(left, "cells")
            other = one if once else side(right, "r_cells")
            ids, x, single, home, visits, chunks, best = one
            r_ids, r_x, r_single, r_home, r_visits, r_chunks, r_best = other
            # what single precision may take from a score of unit vectors
            slack = (2 * x.shape[1] + 32) * 2.0**-24
            gathered = max(1024, _CHUNK_SCORES // max(1, x.shape[1]))
            for i, rows in enumerate(chunks):
                for j in range(i if once else 0, len(r_chunks)):
                    cols, both = r_chunks[j], not once or i != j
                    r, c = meeting(rows, visits, r_home[cols.start]), meeting(cols, r_visits, home[rows.start])
                    if not len(r) or not len(c):
                        continue
                    least, r_least = ((np.maximum(b.least[at], min_similarity) - slack).astype(np.float32) for b, at in ((best[i], r), (r_best[j], c)))
                    at, r_at = r + rows.start, c + cols.start
                    score = single[at] @ r_single[r_at].T
                    close = (score >= least[:, None]) | (score >= r_least[None, :]) if both else score >= least[:, None]
                    if 16 * np.count_nonzero(close) > close.size:
                        score = np.round(x[at] @ r_x[r_at].T, 12)
                        score[(score < min_similarity) | (ids[at, None] == r_ids[None, r_at])] = -np.inf
                        p, q = np.nonzero(best_of_rows(score, k))
                        best[i].add(r[p], r_ids[r_at[q]], score[p, q])
                        if both:
                            q, p = np.nonzero(best_of_rows(score.T, k))
                            r_best[j].add(c[q], ids[at[p]], score[p, q])
                        continue
                    ps, qs = np.nonzero(close)
                    for start in range(0, len(ps), gathered):
                        p, q = ps[start:start + gathered], qs[start:start + gathered]
                        exact = np.round(np.einsum("ij,ij->i", x[at[p]], r_x[r_at[q]]), 12)
                        use = (exact >= min_similarity) & (ids[at[p]] != r_ids[r_at[q]])
                        p, q, exact = p[use], q[use], exact[use]
                        best[i].add(r[p], r_ids[r_at[q]], exact)
                        if both:
                            r_best[j].add(c[q], ids[at[p]], exact)
            for names, slices, bests in ((ids, chunks, best), *([] if once else [(r_ids, r_chunks, r_best)])):
                for chunk, one_best in zip(slices, bests):
                    row, others, scores = one_best.cut()
                    found.append((names[chunk][row], others, scores))
        best_ids, others, scores = (np.concatenate(c) for c in zip(*found))
        return pa.table({"id": best_ids, "other": others, "score": scores})

    return kernel


def similar_items(vectors: DataFrame, k: int = 10, min_similarity: float = 0.6, n_pivots: int | None = None) -> DataFrame:
    """``(id, other, score)``: up to k items of cosine at least ``min_similarity`` for each item.

    There is a pivot for every ``RIGHT_BLOCK`` items, up to ``PIVOTS``; with one pivot all pairs are scored. Groups lie in
    blocks as large as a task holds, so that a vector travels at most once per block, and a pair of vectors is scored once.
    """
    n_pivots = n_pivots or min(PIVOTS, math.ceil(vectors.count() / RIGHT_BLOCK))
    if n_pivots <= 1:
        unit = _plain(unit_vectors(vectors))
        return best_partners(unit, unit, k, min_score=min_similarity, exclude_same=True)
    normed = _stored_lengths(vectors)
    some = normed.first()
    if not some:
        return normed.select("id", F.col("id").alias("other"), F.lit(0.0).alias("score"))
    grouped, groups = _visits(normed, min_similarity, n_pivots)
    total = sum(g["n"] for g in groups)
    block = min(SIMILAR_BLOCK, max(RIGHT_BLOCK, SIMILAR_CELLS // max(1, len(some["features"]))))
    # half as many pairs of blocks as there are blocks squared
    blocks = block_count(total, block, SIMILAR_CHUNK, 2 * vectors.sparkSession.sparkContext.defaultParallelism)
    # a group is cut into parts of about a chunk, and the parts of all groups in a row into blocks
    parts = [math.ceil(g["n"] / SIMILAR_CHUNK) for g in groups]
    begin = np.cumsum([0, *(g["n"] for g in groups)]).tolist()
    reach = [[(begin[i] + p * groups[i]["n"] // n) * blocks // total for p in (0, n - 1)] for i, n in enumerate(parts)]
    by_home = {g["home"]: i for i, g in enumerate(groups)}
    number = F.element_at(F.array([F.lit(by_home.get(h, 0)) for h in range(max(by_home) + 1)]), F.col("home") + 1)

    def of_group(xs: list, c: Column) -> Column:
        return F.element_at(F.array([F.lit(x).cast("bigint") for x in xs]), c + 1)

    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)

    group = F.col("group")
    visits = F.aggregate("visits", F.lit(0).cast("bigint"), lambda s, i: s.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i % 64)))
    units = grouped.withColumn("group", number).withColumn("bits", visits)
    units = units.withColumn("part", F.pmod(F.xxhash64("id"), of_group(parts, group)).cast("int"))
    units = units.groupBy("group", "part").agg(
        F.collect_list(F.struct("id", "features", "norm", F.col("group").alias("home"), F.col("bits").alias("visits"))).alias("cells"),
        F.bit_or("bits").alias("bits"),
    )
    place = of_group(begin, group) + div(F.col("part") * of_group([g["n"] for g in groups], group), of_group(parts, group))
    own = div(place * blocks, F.lit(total)).cast("int")
    seen = F.filter(F.sequence(F.lit(0), F.lit(len(groups) - 1)), lambda i: F.call_function("shiftright", F.col("bits"), i % 64).bitwiseAND(F.lit(1).cast("bigint")) == 1)
    reached = F.array_distinct(F.flatten(F.transform(seen, lambda i: F.sequence(of_group([f[0] for f in reach], i), of_group([f[-1] for f in reach], i)))))
    sent = units.select(own.alias("own"), "cells", F.explode(reached.cast("array<int>")).alias("to"))
    left = sent.filter("to >= own").select(F.col("own").alias("lb"), F.col("to").alias("rb"), "cells")
    right = sent.filter("to < own").select(F.col("to").alias("lb"), F.col("own").alias("rb"), "cells")
    return _top(_meet(left, right, _similar_kernel(k, min_similarity)), k)


def compared_pairs(vectors: DataFrame, min_similarity: float = 0.6, n_pivots: int = PIVOTS) -> DataFrame:
    """One row: ``n_pairs`` of items, and ``n_scored``, those of an item and a group that it visits (both in either order)."""
    visits, groups = _visits(_stored_lengths(vectors), min_similarity, n_pivots)
    size = F.element_at(F.array([F.lit(g["n"]) for g in groups] or [F.lit(0)]), F.col("visit") + 1)
    total = sum(g["n"] for g in groups)
    return visits.withColumn("visit", F.explode("visits")).agg(
        F.lit(total * total).alias("n_pairs"), F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("n_scored")
    )


def user_lists(best: DataFrame) -> DataFrame:
    """``(uid, recommendations)``."""
    return as_list(best, "id", "other", "score").withColumnRenamed("id", "uid")


def item_lists(best: DataFrame) -> DataFrame:
    """``(mid, recommendations)``."""
    return as_list(best, "id", "other", "score").withColumnRenamed("id", "mid")
