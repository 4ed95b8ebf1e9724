"""Recommendations from the ratings of similar users, and their explanation by similar items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumetra.operators.similarity import both_ways, pearson_of_pairs
from lumetra.operators.skew import HOT_PAIRS, HOT_ROWS, found, hot_keys, split_join
from lumetra.operators.topk import top_k
from lumetra.session import stored

MIN_VOTES = 2
STRETCH = 4096  # of items whose ratings by a user travel together


def _votes(voted: DataFrame, ratings: DataFrame) -> DataFrame:
    """Similarity-weighted mean of the neighbours' ratings, for pairs with two votes or more,
    kept within the range of the ratings."""
    bounds = ratings.select(F.struct(F.min("rating").alias("low"), F.max("rating").alias("high"))).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    weighted = F.try_divide(F.sum(F.col("sim") * F.col("rating")), F.sum("sim"))
    return (
        voted.groupBy("user", "item")
        .agg(F.count(F.lit(1)).alias("_votes"), weighted.alias("_estimate"))
        .filter((F.col("_votes") >= MIN_VOTES) & F.col("_estimate").isNotNull())
        .select("user", "item", F.greatest(F.least(F.col("_estimate"), high), low).alias("prediction"))
    )


def _others(ratings: DataFrame) -> DataFrame:
    return ratings.select(F.col("user").alias("other"), "item", "rating")


def estimates(
    neighbours: DataFrame, ratings: DataFrame, hot_rows: int = HOT_ROWS, hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """``(user, item, prediction)`` of all items that the neighbours rated.

    A neighbour's ratings travel to the user as packed lists, and are unpacked and summed there without another shuffle.
    """
    others = _others(ratings)
    hot = found(hot_keys(neighbours, others, ["other"], hot_rows, hot_pairs))
    cells = F.collect_list(F.struct("item", "rating"))
    packed = others.groupBy("other", F.floor(F.col("item") / STRETCH).alias("_s")).agg(cells.alias("l")).select(
        "other", F.col("l.item").alias("items"), F.col("l.rating").alias("ratings"))
    met = split_join(neighbours, packed, ["other"], ["user"], hot).select("user", "sim", "items", "ratings").repartition("user")
    voted = met.select("user", "sim", F.explode(F.arrays_zip("items", "ratings")).alias("o"))
    return _votes(voted.select("user", "sim", F.col("o.items").alias("item"), F.col("o.ratings").alias("rating")), ratings)


def estimates_of(
    pairs: DataFrame, neighbours: DataFrame, ratings: DataFrame, hot_rows: int = HOT_ROWS, hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """As ``estimates``, of the given unique pairs ``(user, item)`` alone: each meets its user's neighbours, and these
    their rating of the item."""
    asked = pairs.select("user", "item")
    hot = found(hot_keys(asked, neighbours, ["user"], hot_rows, hot_pairs))
    met = split_join(asked, neighbours, ["user"], ["item"], hot)
    return _votes(met.join(_others(ratings), ["other", "item"]), ratings)


def recommend(
    neighbours: DataFrame, ratings: DataFrame, how_many: int, seen: DataFrame | None = None,
    for_users: Column | None = None,
) -> DataFrame:
    """``(user, item, prediction)``: the best unseen items of each user.

    ``seen`` defaults to the ratings. ``for_users`` is a condition on ``user``, to ask for some
    users only; it applies to the neighbour lists, before any join.
    """
    asked = neighbours if for_users is None else neighbours.filter(for_users)
    had = (ratings if seen is None else seen).select("user", "item")
    unseen = estimates(asked, ratings).join(had, ["user", "item"], "left_anti")
    return top_k(unseen, ["user"], [F.desc(F.round("prediction", 12)), F.asc("item")], how_many)


def recommended_because(
    targets: DataFrame, ratings: DataFrame, item_pairs: DataFrame | None = None, how_many: int = 10,
    hot_rows: int = HOT_ROWS, hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """``(user, item, because, score)``: the user's own items that speak most for an item.

    ``targets`` are unique pairs ``(user, item)``; ``item_pairs`` is ``(a, b, sim)`` in both orders. Without them,
    similarities are computed for the asked pairs of a target and an own item alone.
    """
    own = ratings.select("user", F.col("item").alias("because"), "rating")
    asked = targets.select("user", "item")
    hot_users = found(hot_keys(own, asked, ["user"], hot_rows, hot_pairs))
    candidates = split_join(own, asked, ["user"], ["because"], hot_users).filter(F.col("because") != F.col("item"))

    if item_pairs is None:
        pair = candidates.select(F.least("item", "because").alias("a"), F.greatest("item", "because").alias("b")).distinct()
        item_pairs = stored(both_ways(pearson_of_pairs(pair, ratings, "item", "user", hot_rows=hot_rows, hot_pairs=hot_pairs)), "similar")

    # A pair of items occurs at most once per target of its first item.
    sims = item_pairs.select(F.col("a").alias("item"), F.col("b").alias("because"), "sim")
    often = asked.groupBy("item").agg(F.ceil(F.count(F.lit(1)) / F.lit(hot_rows)).cast("int").alias("_parts"))
    hot_items = found(often.filter(F.col("_parts") > 1))
    scored = split_join(candidates, sims, ["item", "because"], ["user"], hot_items).select(
        "user", "item", "because", ((1 + F.col("sim")) * F.col("rating")).alias("score")
    )
    return top_k(scored, ["user", "item"], [F.desc(F.round("score", 12)), F.asc("because")], how_many)
