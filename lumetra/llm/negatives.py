"""Hard negatives by angular triangle filtering.

Every vector is stored with its norm and its angles to a few reference directions. For two vectors with angles s and t to a
direction, the angle between them lies between |s - t| and the smaller of s + t and 2 pi - (s + t). The tightest of these
over all directions gives an interval of cosines; times both norms, and widened by more than any rounding, it bounds the
score. Only candidates whose interval overlaps a window that is asked for are scored, in whole numbers.

Shards of the rows meet blocks of anchors, each a packed row, twice: first for the positives, whose window is open above and
rises with the best found so far; then for the negatives, whose windows follow from the positives' scores. Only the best of
a shard for each anchor or window leave it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumetra.llm.asking import forget, kept
from lumetra.llm.topk import exact_scores

REFERENCES, SAMPLE = 16, 2048
SLACK = 1e-6  # radians; stored angles are rounded to single precision (3e-7), and arccos near 0 is off by 2e-8
PACKED = ("shard int, ids binary, labels binary, vectors binary, norms binary, angles binary, keys binary, "
          "windows array<array<struct<positive_id: long, score: long>>>")
POSITIVES = "anchor_id long, _key long, positive_id long, score long"
NEGATIVES = "anchor_id long, _key long, p int, positive_id long, negative_id long, positive_score long, negative_score long"


def prepared(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label",
             scale: int = 256) -> DataFrame:
    """``vec_id``, ``label`` and ``v``, each component x as floor(scale * x). Rows without an id, label or vector, or with
    a null or non-finite component, are left out."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & (F.abs(e) < float("inf")) & ~F.isnan(e))
    label = (F.col(label) if isinstance(label, str) else label).cast("long")
    return rows.where(F.col(id_col).isNotNull() & label.isNotNull() & x.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), F.transform(x, lambda e: F.floor(scale * e)).alias("v")
    )


def references(rows: DataFrame, n: int = REFERENCES, sample: int = SAMPLE) -> np.ndarray:
    """Up to ``n`` directions, one a row: of at most ``sample`` rows (those of smallest hash), each the one farthest from
    those before. They only decide how tight the bounds are."""
    vectors = [r["v"] for r in rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(sample).select("v").collect()]
    width = max(map(len, vectors), default=0)
    x = np.array([v + [0] * (width - len(v)) for v in vectors], np.float64).reshape(len(vectors), width)
    norms = np.sqrt((x * x).sum(axis=1))
    x = x[norms > 0] / norms[norms > 0, None]
    chosen: list[int] = [0] if len(x) else []
    nearest = np.full(len(x), -2.0)
    while chosen and len(chosen) < min(n, len(x)):
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
        far = int(np.argmin(nearest))
        if nearest[far] > 1 - 1e-9:
            break
        chosen.append(far)
    return x[chosen]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    values, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def packed(rows: DataFrame, directions: np.ndarray, shards: int, seed: int) -> DataFrame:
    """Rows by a hash in ``shards`` rows of arrays, by ascending id: with norms and the angles to ``directions``."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        table = table.take(pa.array(np.argsort(table.column("vec_id").to_numpy(), kind="stable")))
        column = table.column("v").combine_chunks()
        x = _matrix(column, int(np.diff(column.offsets.to_numpy()).max(initial=0)))
        f = x.astype(np.float64)
        norms = np.sqrt((f * f).sum(axis=1))
        # what is longer than the directions has no part along them
        width = max(f.shape[1], directions.shape[1])
        along = np.pad(f, ((0, 0), (0, width - f.shape[1]))) @ np.pad(directions, ((0, 0), (0, width - directions.shape[1]))).T
        angles = np.arccos(np.clip(along / np.where(norms > 0, norms, 1)[:, None], -1, 1)).astype(np.float32)
        out = {
            "shard": pa.array(table.column("shard").to_numpy()[:1], pa.int32()),
            **{name: pa.array([a.tobytes()], pa.binary()) for name, a in (
                ("ids", table.column("vec_id").to_numpy()), ("labels", table.column("label").to_numpy()), ("vectors", x),
                ("norms", norms), ("angles", angles), ("keys", table.column("_key").to_numpy()),
            )},
            "windows": pa.array([table.column("window").to_pylist()], schema.field("windows").type),
        }
        return pa.table(out, schema=schema)

    window = pa.list_(pa.list_(pa.struct([("positive_id", pa.int64()), ("score", pa.int64())])))
    schema = pa.schema([("shard", pa.int32())] + [(n, pa.binary()) for n in ("ids", "labels", "vectors", "norms", "angles", "keys")]
                       + [("windows", window)])
    if "window" not in rows.columns:
        rows = rows.withColumn("window", F.array().cast("array<struct<positive_id: long, score: long>>"))
    dealt = rows.select(
        "vec_id", "label", "v", "window", F.xxhash64("label", "v").alias("_key"),
        F.pmod(F.xxhash64("vec_id", "v", F.lit(seed)), F.lit(shards)).cast("int").alias("shard"),
    )
    return kept(dealt.groupBy("shard").applyInArrow(pack, PACKED), "packed")


class Shard:
    """A row of ``packed`` as arrays."""

    def __init__(self, row: dict, n_directions: int):
        self.ids, self.labels, self.keys = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "keys"))
        self.vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(self.ids), -1)
        self.norms = np.frombuffer(row["norms"])
        self.angles = np.frombuffer(row["angles"], np.float32).reshape(len(self.ids), n_directions).astype(np.float64)
        self.windows = row["windows"]


def bounds(norm: float, angles: np.ndarray, norms: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and highest score that a vector can have with others, by norms and angles."""
    apart, together = np.abs(others - angles), others + angles
    least = np.maximum(apart.max(axis=1, initial=0) - SLACK, 0)
    most = np.minimum(np.minimum(together, 2 * np.pi - together).min(axis=1, initial=np.pi) + SLACK, np.pi)
    size = norm * norms
    margin = 1e-9 * size + 1e-6
    return size * np.cos(most) - margin, size * np.cos(least) + margin


class Scorer:
    """Whole scores of a shard's rows with an anchor: by doubles where these are exact, else by longs."""

    def __init__(self, shard: Shard, block: Shard):
        width = max(shard.vectors.shape[1], block.vectors.shape[1])
        self.x, self.y = (np.pad(s.vectors, ((0, 0), (0, width - s.vectors.shape[1]))) for s in (shard, block))
        largest = [float(np.abs(m.astype(np.float64)).max(initial=0)) + 1 for m in (self.x, self.y)]
        self.exact = width * largest[0] * largest[1] < 2.0**53
        if self.exact:
            self.x, self.y = self.x.astype(np.float64), self.y.astype(np.float64)

    def __call__(self, anchor: int, rows: np.ndarray) -> np.ndarray:
        if self.exact:
            return (self.x[rows] @ self.y[anchor]).astype(np.int64)
        return exact_scores(self.x[rows], self.y[anchor], np.ones(len(rows), bool))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, ~scores))[:k]  # ~ turns the order of all longs round


def positives_in(shard: Shard, block: Shard, k: int) -> Iterator[tuple]:
    """Rows of ``POSITIVES``: of each anchor the k best others of its label within the shard."""
    score = Scorer(shard, block)
    by_label = np.argsort(shard.labels, kind="stable")
    labels = shard.labels[by_label]
    for a, (own, label, key) in enumerate(zip(block.ids, block.labels, block.keys, strict=True)):
        rows = by_label[np.searchsorted(labels, label) : np.searchsorted(labels, label, side="right")]
        rows = rows[shard.ids[rows] != own]
        _, high = bounds(block.norms[a], block.angles[a], shard.norms[rows], shard.angles[rows])
        order = np.argsort(-high, kind="stable")
        first, rest = order[: 4 * k], order[4 * k :]
        rows_, scores = rows[first], score(a, rows[first])
        if len(rest):
            floor = np.sort(scores)[-k]
            more = rows[rest[high[rest] >= floor]]
            rows_, scores = np.concatenate([rows_, more]), np.concatenate([scores, score(a, more)])
        for i in _best(shard.ids[rows_], scores, k):
            yield int(own), int(key), int(shard.ids[rows_[i]]), int(scores[i])


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The whole scores between ``low`` and ``high`` per cent of one."""
    return -(-low * score // 100), high * score // 100


def negatives_in(shard: Shard, block: Shard, k: int, low: int, high: int) -> Iterator[tuple]:
    """Rows of ``NEGATIVES``: for each anchor and positive the k best of other labels within its window."""
    score = Scorer(shard, block)
    for a, (own, label, key) in enumerate(zip(block.ids, block.labels, block.keys, strict=True)):
        windows = [(p, w["positive_id"], w["score"], *window(w["score"], low, high)) for p, w in enumerate(block.windows[a])]
        windows = [w for w in windows if w[3] <= w[4]]
        if not windows:
            continue
        rows = np.flatnonzero(shard.labels != label)
        least, most = bounds(block.norms[a], block.angles[a], shard.norms[rows], shard.angles[rows])

        def overlap(which: np.ndarray) -> np.ndarray:
            near = np.zeros(len(which), bool)
            for *_, lo, hi in windows:
                near |= (most[which] >= lo) & (least[which] <= hi)
            return which[near]

        found: dict[int, tuple[np.ndarray, np.ndarray]] = {w[0]: (np.empty(0, np.int64),) * 2 for w in windows}
        for part in (np.arange(min(len(rows), 64 * k)), np.arange(min(len(rows), 64 * k), len(rows))):
            near = rows[overlap(part)]
            scores = score(a, near)
            for i, (p, positive, ps, lo, hi) in enumerate(windows):
                within = (scores >= lo) & (scores <= hi)
                ids, values = np.concatenate([found[p][0], shard.ids[near[within]]]), np.concatenate([found[p][1], scores[within]])
                best = _best(ids, values, k)
                found[p] = ids[best], values[best]
                if len(best) == k:  # nothing below the k-th best gets in any more
                    windows[i] = (p, positive, ps, int(values[best[-1]]), hi)
        for p, positive, ps, _, _ in windows:
            for n, s in zip(*found[p], strict=True):
                yield int(own), int(key), p, positive, int(n), ps, int(s)


def _meet(shards: DataFrame, n_shards: int, blocks: DataFrame, n_blocks: int, n_directions: int,
          search: Callable[[Shard, Shard], Iterator[tuple]], schema: str) -> DataFrame:
    """``search`` of each shard and block."""
    names = [c.split()[0] for c in schema.split(", ")]
    arrow = pa.schema([(c.split()[0], pa.int32() if c.endswith(" int") else pa.int64()) for c in schema.split(", ")])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for s in left.to_pylist():
            for b in right.to_pylist():
                rows += search(Shard(s, n_directions), Shard(b, n_directions))
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = shards.withColumn("block", every(n_blocks))
    right = blocks.withColumnRenamed("shard", "block").withColumn("shard", every(n_shards))
    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(run, schema)


def mine(rows: DataFrame, anchors: DataFrame, n_positives: int = 5, k: int = 10, low: int = 30, high: int = 90,
         per_shard: int = 8192, per_block: int = 1024) -> DataFrame:
    """For each anchor and each of its best ``n_positives`` others of its label, the ``k`` best of other labels whose score
    is between ``low`` and ``high`` per cent of the positive's: ``anchor_id``, ``positive_id``, ``rank`` from 1,
    ``negative_id``, ``positive_score``, ``negative_score``.

    Both inputs are as of ``prepared``; anchors take part as candidates as well, if they are among the rows. A row with the
    anchor's own id is no other. Equal scores go to the smaller id; the shorter of two vectors counts as filled with 0.
    Repeated rows count each, repeated anchors are answered once. A positive of negative score has an empty window, one
    of 0 allows scores of 0 only; pairs without any negative give no rows, and empty tables give none. The job fails if
    a score is beyond the longs.
    """
    anchors = anchors.dropDuplicates(["vec_id", "label", "v"])
    n, n_anchors = rows.count(), anchors.count()
    n_shards, n_blocks = max(1, -(-n // per_shard)), max(1, -(-n_anchors // per_block))
    directions = references(rows)
    shards = packed(rows, directions, n_shards, 1)
    asked = packed(anchors, directions, n_blocks, 2)
    found = _meet(shards, n_shards, asked, n_blocks, len(directions), lambda s, b: positives_in(s, b, n_positives), POSITIVES)
    best = Window.partitionBy("anchor_id", "_key").orderBy(F.desc("score"), "positive_id")
    first = found.withColumn("_p", F.row_number().over(best)).where(F.col("_p") <= n_positives)
    windows = kept(first.groupBy("anchor_id", "_key").agg(
        F.array_sort(F.collect_list(F.struct("_p", "positive_id", "score"))).alias("w")
    ).select("anchor_id", "_key", F.transform("w", lambda w: F.struct(w["positive_id"].alias("positive_id"), w["score"].alias("score"))).alias("window")), "windows")
    forget(asked)
    keyed = anchors.withColumn("_key", F.xxhash64("label", "v")).join(
        windows.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "_key"]
    ).select("vec_id", "label", "v", "window")
    asked = packed(keyed, directions, n_blocks, 2)
    forget(windows)
    near = _meet(shards, n_shards, asked, n_blocks, len(directions), lambda s, b: negatives_in(s, b, k, low, high), NEGATIVES)
    order = Window.partitionBy("anchor_id", "_key", "p").orderBy(F.desc("negative_score"), "negative_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
