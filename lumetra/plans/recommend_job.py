"""The recommendation job: a ratings table to a table of recommended items per user."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetra.operators import als
from lumetra.operators import ratings as R
from lumetra.operators.factors import item_lists, user_lists
from lumetra.operators.topk import sequential_id
from lumetra.session import stored
from lumetra.sources.jdbc import JdbcTarget, append_jdbc
from lumetra.sources.tables import read_table, replace_table, table_columns


@dataclass(frozen=True)
class JobReport:
    profile: DataFrame
    leaderboard: DataFrame
    best: als.AlsParams
    validation_rmse: float
    test_rmse: float
    baseline_rmse: float
    improvement_percent: float
    bad_ratings: int


def flat_recommendations(model, n: int, user_col: str, item_col: str) -> DataFrame:
    """``(id, <user>, <item>, predict)``, numbered by user, descending score and item."""
    flat = als.recommend_for_users(model, n).select(
        F.col("id").cast("int").alias("_u"), F.col("other").cast("int").alias("_i"), F.col("score").alias("predict")
    )
    numbered = sequential_id(flat, [F.asc("_u"), F.desc("predict"), F.asc("_i")])
    return numbered.toDF("id", user_col, item_col, "predict")


def run_recommendation_job(
    spark: SparkSession, source: str | DataFrame, target: str, top_n: int | None = None,
    jdbc: JdbcTarget | None = None, path: str | None = None, ranks: Sequence[int] = tuple(als.GRID_RANKS),
    regs: Sequence[float] = tuple(als.GRID_REGS), iters: Sequence[int] = tuple(als.GRID_ITERS),
    parallelism: int | None = None,
) -> JobReport:
    """Profile, split 60/20/20, search parameters, measure on the test part, refit on all ratings,
    write the best items of every user to ``target`` and, if asked, append them to a database."""
    n = top_n if top_n is not None else R.top_n_for(str(source))
    user_col, item_col = table_columns(spark, source)[:2]
    cast = R.cast_ratings(read_table(spark, source))
    pairs = R.unique_pairs(cast.filter(F.col("reason").isNull()))
    parts = stored(R.split_parts(pairs, R.SPLIT_60_20_20))
    train, validation, test = (parts.filter(F.col("part") == p) for p in ("train", "validation", "test"))

    found = als.grid_search(train, validation, ranks, regs, iters, parallelism)
    test_rmse = als.rmse(found.model, test)
    baseline_rmse = R.mean_baseline(parts).first()["rmse"]

    model = als.fit(parts.drop("part"), found.best)
    replace_table(flat_recommendations(model, n, user_col, item_col), target, path)
    if jdbc is not None:
        append_jdbc(spark.table(target), jdbc)
    return JobReport(
        profile=R.profile(parts), leaderboard=found.leaderboard, best=found.best,
        validation_rmse=found.validation_rmse, test_rmse=test_rmse, baseline_rmse=baseline_rmse,
        improvement_percent=R.improvement(baseline_rmse, test_rmse),
        bad_ratings=cast.filter(F.col("reason").isNotNull()).count(),
    )


@dataclass(frozen=True)
class SimilarityLists:
    users: DataFrame
    items: DataFrame


def run_similarity_job(
    spark: SparkSession, source: str | DataFrame, limit: int | None = None, n: int = 10,
    min_similarity: float = 0.6, params: als.AlsParams = als.AlsParams(**als.SIMILARITY_PARAMS),
) -> SimilarityLists:
    """From ``(user_id, track_id, score)``: each user's best items ``(uid, recommendations)`` and
    each item's similar items ``(mid, recommendations)``. ``limit`` takes the first rows by ids."""
    table = read_table(spark, source).select("user_id", "track_id", "score")
    if limit is not None:
        table = table.orderBy("user_id", "track_id", "score").limit(limit)
    cast = R.cast_ratings(table).filter(F.col("reason").isNull())
    model = als.fit(R.unique_pairs(cast), params)
    return SimilarityLists(
        users=user_lists(als.positive_lists(model, n)),
        items=item_lists(als.item_similarity(model, n, min_similarity)),
    )
