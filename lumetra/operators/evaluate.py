"""Evaluation of the neighbourhood recommender: hold-out error, precision and recall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetra.operators import similarity as S
from lumetra.operators.neighborhood import estimates_of, recommend
from lumetra.operators.ratings import SPLIT_70_30, error_metrics, join_predictions, split_parts
from lumetra.operators.topk import top_k
from lumetra.session import stored


def holdout_errors(ratings: DataFrame, n_neighbours: int = 2) -> DataFrame:
    """One row ``(mae, rmse, n_scored)``: learn from 70 % of the pairs, estimate the others and nothing else.

    Pairs without an estimate are left out.
    """
    parts = split_parts(ratings, SPLIT_70_30)
    train = stored(parts.filter(F.col("part") == "train").drop("part"), "train")
    test = parts.filter(F.col("part") == "test").drop("part")
    neighbours = stored(S.nearest(train, n_neighbours))
    return error_metrics(join_predictions(estimates_of(test, neighbours, train), test))


def relevance_threshold(ratings: DataFrame) -> DataFrame:
    """``(user, n_ratings, threshold)``: mean plus sample standard deviation; none below two ratings."""
    spread = F.coalesce(F.avg("rating") + F.stddev_samp("rating"), F.lit(float("-inf")))
    return ratings.groupBy("user").agg(F.count(F.lit(1)).alias("n_ratings"), spread.alias("threshold"))


def relevant_items(ratings: DataFrame, at: int) -> DataFrame:
    """``(user, item)``: of each user's ``at`` best ratings those that reach the threshold, for
    users with at least ``2 * at`` ratings."""
    best = top_k(ratings, ["user"], [F.desc("rating"), F.asc("item")], at)
    return (
        best.join(relevance_threshold(ratings), "user")
        .filter((F.col("rating") >= F.col("threshold")) & (F.col("n_ratings") >= 2 * at))
        .select("user", "item")
    )


def precision_recall(ratings: DataFrame, at: int = 4, n_neighbours: int = 4) -> DataFrame:
    """One row: ``precision, recall, n_users, n_recommended, n_hits``.

    Each user is judged without their relevant items against all others' full ratings: one
    similarity job of the reduced against the full ratings instead of one model per user.
    """
    relevant = stored(relevant_items(ratings, at))
    judged = relevant.groupBy("user").agg(F.count(F.lit(1)).alias("n_relevant"))
    reduced = stored(ratings.join(judged.select("user"), "user", "left_semi").join(
        relevant, ["user", "item"], "left_anti"
    ), "reduced")
    neighbours = stored(S.nearest(reduced, n_neighbours, others=ratings))
    recommended = recommend(neighbours, ratings, at, seen=reduced)
    hits = recommended.join(relevant.withColumn("_hit", F.lit(1)), ["user", "item"], "left")
    by_user = hits.groupBy("user").agg(F.count(F.lit(1)).alias("n_rec"), F.count("_hit").alias("n_hit"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0))
    return judged.join(by_user, "user", "left").agg(
        F.avg(F.col("n_hit") / F.col("n_rec")).alias("precision"),
        F.avg(n_hit / F.col("n_relevant")).alias("recall"),
        F.count(F.lit(1)).alias("n_users"),
        F.coalesce(F.sum("n_rec"), F.lit(0)).alias("n_recommended"),
        F.sum(n_hit).alias("n_hits"),
    )
