"""Matrix factorisation: fit, predict, grid search, recommendation lists."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from itertools import product
from multiprocessing.pool import ThreadPool
from threading import Lock

import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetra.operators.factors import best_items, similar_items
from lumetra.operators.ratings import error_metrics
from lumetra.session import shared_dir

SEED = 42

# Parameters of the similarity job and of the grid search, in search order.
SIMILARITY_PARAMS = {"rank": 50, "max_iter": 5, "reg": 0.01}
GRID_RANKS = [5, 10, 15, 20]
GRID_REGS = [0.01, 0.1]
GRID_ITERS = [5, 10]


@dataclass(frozen=True)
class AlsParams:
    rank: int
    reg: float
    max_iter: int


RATINGS_PER_BLOCK = 25_000
RATINGS_PER_MESSAGE = 1_000
MOST_PER_BLOCK = 20_000_000
FEW_BLOCKS, IDS_PER_BLOCK = 8, 64


def factor_blocks(n_ratings: int, ratings_per_block: int = RATINGS_PER_BLOCK) -> int:
    """Blocks of users and of items. Factors start per block, so the number follows from the ratings alone and the
    same data gives the same model on any machine.

    An iteration sends a message per pair of blocks, so small blocks are made only while messages stay below one per
    ``RATINGS_PER_MESSAGE`` ratings; beyond that blocks grow with the root of the ratings, up to what a task can hold.
    """
    fine = math.ceil(n_ratings / ratings_per_block)
    few_messages = math.ceil(math.sqrt(n_ratings / RATINGS_PER_MESSAGE))
    return max(1, min(fine, few_messages), math.ceil(n_ratings / MOST_PER_BLOCK))


def block_grid(ratings: DataFrame) -> tuple[int, int]:
    """Blocks of users and of items: no more than there are of either, by mergeable sketches that any machine gets alike.

    A factor is sent to each block that has a rating with it, so beyond ``FEW_BLOCKS`` a block has ``IDS_PER_BLOCK`` ids or more,
    unless that makes it larger than a task can hold.
    """
    row = ratings.agg(F.count(F.lit(1)), F.approx_count_distinct("user"), F.approx_count_distinct("item")).first()
    blocks = factor_blocks(row[0])
    least = max(FEW_BLOCKS, math.ceil(row[0] / MOST_PER_BLOCK))
    users, items = (min(blocks, max(1, n), max(least, n // IDS_PER_BLOCK)) for n in row[1:])
    return users, items


def fit(ratings: DataFrame, params: AlsParams, seed: int = SEED, blocks: int | tuple[int, int] | None = None) -> ALSModel:
    """Explicit-feedback ALS on ``(user INT, item INT, rating)``, one row per pair.

    Unique pairs bound a popular item's or busy user's rows. Long lineages are cut in the
    checkpoint folder every few iterations.
    """
    spark = ratings.sparkSession
    shared_dir(spark)
    users, items = (blocks, blocks) if isinstance(blocks, int) else blocks or block_grid(ratings)
    als = ALS(
        rank=params.rank, maxIter=params.max_iter, regParam=params.reg, seed=seed, numUserBlocks=users,
        numItemBlocks=items, userCol="user", itemCol="item", ratingCol="rating", implicitPrefs=False,
        nonnegative=False, coldStartStrategy="drop", checkpointInterval=5,
    )
    return als.fit(ratings)


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``prediction`` for given pairs; pairs with an unknown user or item are left out."""
    return model.transform(pairs).withColumn("prediction", F.col("prediction").cast("double"))


def rmse(model: ALSModel, ratings: DataFrame) -> float:
    value = error_metrics(predict(model, ratings)).first()["rmse"]
    return math.nan if value is None else value


@dataclass(frozen=True)
class GridResult:
    leaderboard: DataFrame
    best: AlsParams
    model: ALSModel
    validation_rmse: float


def grid_search(
    train: DataFrame, validation: DataFrame, ranks: Sequence[int] = tuple(GRID_RANKS),
    regs: Sequence[float] = tuple(GRID_REGS), iters: Sequence[int] = tuple(GRID_ITERS),
    parallelism: int | None = None, seed: int = SEED,
) -> GridResult:
    """Fit every combination, ``parallelism`` at a time (two to eight, more the less one fit fills
    the cluster), and keep the smallest validation RMSE; the first in rank, regularisation,
    iteration order wins a tie."""
    spark = train.sparkSession
    level = StorageLevel.MEMORY_AND_DISK
    inputs = [df.select("user", "item", "rating").persist(level) for df in (train, validation)]
    grid = [AlsParams(rank, reg, n) for rank, reg, n in product(ranks, regs, iters)]

    try:
        cores = spark.sparkContext.defaultParallelism
        blocks = block_grid(inputs[0])

        kept: list[tuple[float, int, ALSModel]] = []  # only the best model so far
        one_at_a_time = Lock()

        def run(numbered: tuple[int, AlsParams]) -> float:
            i, params = numbered
            model = fit(inputs[0], params, seed, blocks)
            score = rmse(model, inputs[1])
            with one_at_a_time:
                if not math.isnan(score) and (not kept or (score, i) < kept[0][:2]):
                    kept[:] = [(score, i, model)]
            return score

        with ThreadPool(parallelism or max(2, min(8, 2 * cores // max(blocks)))) as pool:
            scores = pool.map(inheritable_thread_target(spark)(run), list(enumerate(grid)), chunksize=1)
    finally:
        for df in inputs:
            df.unpersist()
    if not kept:
        raise ValueError("no validation pair has a known user and item")
    lowest, best, model = kept[0]
    rows = [
        {"ord": i + 1, **asdict(p), "validation_rmse": scores[i], "is_best": i == best}
        for i, p in enumerate(grid)
    ]
    return GridResult(spark.createDataFrame(pa.Table.from_pylist(rows)), grid[best], model, lowest)


def _vectors(factors: DataFrame) -> DataFrame:
    return factors.select("id", F.col("features").cast("array<double>").alias("features"))


def recommend_for_users(model: ALSModel, n: int) -> DataFrame:
    """``(id, other, score)``: the model's own n best items of each user, whatever the score; seen items stay in."""
    listed = model.recommendForAllUsers(n).select(F.col("user").cast("bigint").alias("id"), F.inline("recommendations"))
    return listed.select("id", F.col("item").cast("bigint").alias("other"), F.col("rating").cast("double").alias("score"))


def positive_lists(model: ALSModel, n: int = 10) -> DataFrame:
    """``(id, other, score)``: up to n items of positive score for each user."""
    return best_items(_vectors(model.userFactors), _vectors(model.itemFactors), n)


def item_similarity(model: ALSModel, n: int = 10, min_similarity: float = 0.6) -> DataFrame:
    """``(id, other, score)``: up to n similar items of each item by the cosine of their factors."""
    return similar_items(_vectors(model.itemFactors), n, min_similarity)
