"""Top-k per group, sequential ids, list columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumetra.session import stored

# Spark cuts a row_number() <= k window before its shuffle up to this k
# (spark.sql.optimizer.windowGroupLimitThreshold).
_CUT_BEFORE_SHUFFLE = 1000


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group. Give a full order, so that ties are settled.

    For k in Spark's group-limit range each task keeps k rows per group before the shuffle, so a
    hot group costs k rows per task. Beyond it, groups are first cut within 64 hashed parts.
    """
    name = rank or "_rank"
    if k > _CUT_BEFORE_SHUFFLE:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(64))
        within = Window.partitionBy(*keys, "_part").orderBy(*order)
        df = (
            df.withColumn("_part", part).withColumn("_within", F.row_number().over(within))
            .filter(F.col("_within") <= k).drop("_part", "_within")
        )
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def ordered_limit(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows in a full order. Each task keeps n rows; there is no global sort."""
    return df.orderBy(*order).limit(n)


def as_list(topped: DataFrame, key: str, item: str, score: str, name: str = "recommendations") -> DataFrame:
    """Collect rows already cut to k per group into a list of ``(product, rating)``, best first."""
    pair = F.struct((-F.col(score)).alias("_o"), F.col(item).alias("product"), F.col(score).alias("rating"))
    ordered = F.array_sort(F.collect_list(pair))
    return topped.groupBy(key).agg(
        F.transform(ordered, lambda p: F.struct(p["product"].alias("product"), p["rating"].alias("rating"))).alias(name)
    )


def flatten_list(lists: DataFrame, key: str, name: str = "recommendations") -> DataFrame:
    """One row per list element."""
    return lists.select(key, F.inline(name))


def sequential_id(df: DataFrame, order: Sequence[Column], name: str = "id", partitions: int | None = None) -> DataFrame:
    """Add the ids 1..n in the given order, without a single-task sort.

    Rows are range-sorted by the whole order (a hot leading key spreads over ranges) and stored
    in the checkpoint folder, so that partition numbers cannot change; each range then starts
    after the sum of the ranges before it. Only the per-range counts meet in one task.
    """
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = stored(
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    return ranges.join(F.broadcast(offsets), "_range").select(
        (F.col("_before") + F.col("_pos") + 1).alias(name), *df.columns
    )
