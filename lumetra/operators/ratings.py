"""Ratings: cast, split, profile, baseline, error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumetra.operators.topk import top_k


def cast_ratings(table: DataFrame) -> DataFrame:
    """The three columns of a table, by position, as ``(user INT, item INT, rating DOUBLE)``.

    Rows that do not cast have a ``reason`` instead of failing the job.
    """
    if len(table.columns) != 3:
        raise ValueError(f"a ratings table has three columns, not {len(table.columns)}")
    text = [F.col(c).cast("string") for c in ("user", "item", "rating")]
    out = table.toDF("user", "item", "rating").select(
        text[0].try_cast("int").alias("user"), text[1].try_cast("int").alias("item"),
        text[2].try_cast("double").alias("rating"), F.concat_ws(",", *text).alias("raw"),
    )
    bad = F.col("user").isNull() | F.col("item").isNull() | F.col("rating").isNull()
    return out.withColumn("reason", F.when(bad, "bad_rating"))


def unique_pairs(ratings: DataFrame) -> DataFrame:
    """One row per pair, the mean of its ratings. Bounds a user's or item's rows by the number of
    items or users."""
    return ratings.groupBy("user", "item").agg(F.avg("rating").alias("rating"))


def split_bucket(user: Column, item: Column) -> Column:
    """0..99 from the two ids in integer arithmetic, the same on any engine."""
    return F.pmod(user.cast("bigint") * 7919 + item.cast("bigint") * 104729, F.lit(100))


def split_parts(ratings: DataFrame, bounds: Sequence[tuple[str, int]]) -> DataFrame:
    """Add ``part``: the first name whose upper bound exceeds the pair's bucket."""
    bucket = split_bucket(F.col("user"), F.col("item"))
    part = F.when(bucket < bounds[0][1], bounds[0][0])
    for name, upper in bounds[1:]:
        part = part.when(bucket < upper, name)
    return ratings.withColumn("part", part)


# Shares of training, validation and test.
SPLIT_60_20_20 = [("train", 60), ("validation", 80), ("test", 100)]
SPLIT_70_30 = [("train", 70), ("test", 100)]


def distinct_ids(rows: DataFrame, column: str) -> DataFrame:
    """One row ``n``: the exact number of distinct values of a whole-number column, without nulls.

    Each task sets one bit per value in maps of 4 KB, one per stretch of 32,768 values, and maps of a stretch are merged. So a
    task sends at most its stretches, not its rows; the scan reads the one column. Ids should be dense, as numbered users and
    items are: strewn over all of INT, a task may send half a GB, though it holds one map at a time.
    """
    maps = rows.groupBy(F.bitmap_bucket_number(F.col(column)).alias("stretch")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(column))).alias("bits")
    )
    return maps.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def distinct_counts(ratings: DataFrame, approximate: bool = False) -> DataFrame:
    """One row ``(n_users, n_items)``."""
    if approximate:
        return ratings.agg(F.approx_count_distinct("user").alias("n_users"), F.approx_count_distinct("item").alias("n_items"))
    n_items = distinct_ids(ratings, "item").scalar()
    return distinct_ids(ratings, "user").select(F.col("n").alias("n_users"), n_items.alias("n_items"))


def grid_coverage(ratings: DataFrame) -> DataFrame:
    """``(user, n_cells, n_rated, n_open)``: each user's row of the user-by-item grid.

    The grid itself is never written out: scoring walks it in blocks (``factors``), and its
    counts follow from the number of items.
    """
    n_items = distinct_ids(ratings, "item").scalar()
    rated = ratings.groupBy("user").agg(F.count_distinct("item").alias("n_rated"))
    return rated.select("user", n_items.alias("n_cells"), "n_rated", (n_items - F.col("n_rated")).alias("n_open"))


def known_mean(parts: DataFrame) -> DataFrame:
    """One row: mean and number of the training and validation ratings together."""
    train, validation = (parts.filter(F.col("part") == p) for p in ("train", "validation"))
    return train.unionByName(validation).agg(
        F.avg("rating").alias("mean_rating"), F.count(F.lit(1)).alias("n_ratings")
    )


def user_mean_predictions(known: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(user, item, prediction)``: a user's mean known rating as the prediction."""
    means = known.groupBy("user").agg(F.avg("rating").alias("prediction"))
    return pairs.select("user", "item").join(means, "user")


def split_random(ratings: DataFrame, weights: Sequence[float] = (0.6, 0.2, 0.2), seed: int = 42) -> list[DataFrame]:
    return ratings.randomSplit(list(weights), seed)


def profile(parts: DataFrame) -> DataFrame:
    """One row of counts: ratings, users, items and each part."""
    def rows(name: str) -> Column:
        return F.count_if(F.col("part") == name)

    counts = parts.agg(
        F.count(F.lit(1)).alias("n_ratings"), rows("train").alias("n_train"),
        rows("validation").alias("n_validation"), rows("test").alias("n_test"),
    )
    n_users, n_items = (distinct_ids(parts, c).scalar() for c in ("user", "item"))
    return counts.select(
        "n_ratings", n_users.alias("n_users"), n_items.alias("n_items"), "n_train", "n_validation", "n_test"
    )


def join_predictions(predictions: DataFrame, actual: DataFrame) -> DataFrame:
    """``(user, item, prediction, rating)`` of the pairs in both."""
    return predictions.select("user", "item", "prediction").join(
        actual.select("user", "item", "rating"), ["user", "item"]
    )


def error_metrics(scored: DataFrame) -> DataFrame:
    """One row: ``mae``, ``rmse`` and the number of scored pairs; NULL errors where there is none."""
    diff = F.col("prediction") - F.col("rating")
    return scored.agg(
        F.avg(F.abs(diff)).alias("mae"), F.sqrt(F.avg(diff * diff)).alias("rmse"),
        F.count(F.lit(1)).alias("n_scored"),
    )


def mean_baseline(parts: DataFrame, known: Sequence[str] = ("train", "validation"), test: str = "test") -> DataFrame:
    """One row: the mean of the known ratings and its RMSE as the prediction for the test part.

    sum((m-x)^2) = sum(x^2) - 2m sum(x) + n m^2 would cancel badly; the mean is a one-row
    subquery instead.
    """
    known_rows = parts.filter(F.col("part").isin(*known))
    test_rows = parts.filter(F.col("part") == test)
    mean = known_rows.select(F.avg("rating")).scalar()
    return error_metrics(test_rows.select(mean.alias("prediction"), "rating")).select(
        mean.alias("mean_rating"), "rmse", "n_scored"
    )


def improvement(base_rmse: float, model_rmse: float) -> float:
    """How much smaller the model's error is, in percent."""
    return (base_rmse - model_rmse) / base_rmse * 100


# Length of the recommendation lists by source table.
TOP_N = {
    "music_recommend_app.genre_col_model": 5,
    "music_recommend_app.music_num_model": 50,
    "music_recommend_app.music_play_model": 50,
    "music_recommend_app.rec_score_model": 20,
    "music_recommend_app.rec_cli_model": 20,
}


def source_top_n(scored: DataFrame, config: Mapping[str, int] = TOP_N) -> DataFrame:
    """The best rows of each ``(source, user)`` of ``(source, user, item, predict)``, as many as
    the source's configured length; sources without one give no rows."""
    spark = scored.sparkSession
    lengths = spark.createDataFrame(pa.table({"source": list(config), "_length": list(config.values())}))
    known = scored.join(F.broadcast(lengths), "source")
    order = [F.desc("predict"), F.asc("item")]
    longest = top_k(known, ["source", "user"], order, max(config.values()), rank="_rank")
    return longest.filter(F.col("_rank") <= F.col("_length")).drop("_rank", "_length")


def top_n_for(source: str, config: Mapping[str, int] = TOP_N) -> int:
    if source not in config:
        raise ValueError(f"no list length for {source!r}; give one")
    return config[source]
