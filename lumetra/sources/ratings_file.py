"""Ratings in text files, ``user::item::rating::timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RATINGS_FILE_SCHEMA = "user INT, item INT, rating DOUBLE, ts BIGINT"


def read_ratings_file(spark: SparkSession, path_glob: str) -> DataFrame:
    """``(user, item, rating)``; of several ratings of a pair the latest counts."""
    rows = spark.read.csv(path_glob, sep="::", schema=RATINGS_FILE_SCHEMA)
    return latest_ratings(rows, "ts")


def latest_ratings(rows: DataFrame, order: str) -> DataFrame:
    """One rating per pair, the latest by ``order``; equal times take the higher rating."""
    return rows.groupBy("user", "item").agg(F.max(F.struct(order, "rating"))["rating"].alias("rating"))
