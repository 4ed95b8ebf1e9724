"""Connected components of links between ids, by alternating stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetra.llm.asking import forget, kept


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each ``u``, stored, so that a join with it can split a hot ``u``."""
    return kept(edges.groupBy("u").agg(F.min("v").alias("m")), "least")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest id that links reach, for all nodes but those smallest ones.

    ``links`` has ``u`` and ``v``; loops, repeated links and nulls are ignored. Each round joins every node's neighbours
    to the smallest among them; the number of rounds is about the logarithm of the longest chain. Tables of a round go when
    the next one's are stored; what is returned can be given to ``forget``.
    """
    edges = kept(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        large = kept(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(), "large"
        )
        before, first = edges, least
        least = _least(large)
        joined = large.join(least, "u")
        edges = kept(
            joined.select("u", F.col("m").alias("v")).unionByName(
                joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            ).distinct(), "links",
        )
        forget(before, first, large, least)
        now = edges.agg(F.count("*"), F.sum(F.col("v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            out = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            out.kept_in = edges.kept_in
            return out
        state = now
