import random

import pytest
from pyspark.sql import functions as F

from lumetra.operators import topk as K
from lumetra.operators.skew import found, hot_keys, split_join


def frame(spark, n=3000, seed=1, hot=0.4):
    rng = random.Random(seed)
    rows = [(0 if rng.random() < hot else rng.randrange(1, 30), i, round(rng.random(), 2)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "g int, id int, score double").repartition(4)


@pytest.mark.parametrize("k", [3, 1100])
def test_top_k_with_a_hot_group(spark, k):
    rows, df = frame(spark)
    got = K.top_k(df, ["g"], [F.desc("score"), F.asc("id")], k, rank="r").collect()
    want = {}
    for g, i, s in rows:
        want.setdefault(g, []).append((-s, i))
    want = {(g, i, r) for g, v in want.items() for r, (_, i) in enumerate(sorted(v)[:k], 1)}
    assert {(x["g"], x["id"], x["r"]) for x in got} == want
    assert len(got) == len(want)


def test_top_k_cuts_before_the_shuffle(spark):
    _, df = frame(spark)
    plan = K.top_k(df, ["g"], [F.desc("score"), F.asc("id")], 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_ordered_limit_keeps_no_global_sort(spark):
    _, df = frame(spark)
    out = K.ordered_limit(df, [F.desc("score"), F.asc("id")], 5)
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 5


def test_lists_are_in_order_and_flatten_back(spark):
    _, df = frame(spark, 200)
    top = K.top_k(df, ["g"], [F.desc("score"), F.asc("id")], 4)
    lists = K.as_list(top, "g", "id", "score")
    for row in lists.collect():
        pairs = [(-r["rating"], r["product"]) for r in row["recommendations"]]
        assert pairs == sorted(pairs) and len(pairs) <= 4
    assert K.flatten_list(lists, "g").count() == top.count()


@pytest.mark.parametrize("partitions", [1, 7])
def test_sequential_id_is_gapless_and_ordered(spark, partitions):
    rows, df = frame(spark, 1000, hot=0.9)
    got = K.sequential_id(df, [F.asc("g"), F.desc("score"), F.asc("id")], "n", partitions).collect()
    want = [i for _, _, i in sorted((g, -s, i) for g, i, s in rows)]
    assert [r["id"] for r in sorted(got, key=lambda r: r["n"])] == want
    assert sorted(r["n"] for r in got) == list(range(1, 1001))


def test_sequential_id_of_nothing(spark):
    _, df = frame(spark, 10)
    assert K.sequential_id(df.filter("g < 0"), [F.asc("id")]).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limits", [(10, 10**9), (10**9, 50), (10**9, 10**9)])
def test_split_join_equals_the_plain_join(spark, how, limits):
    _, big = frame(spark, 800)
    small = spark.createDataFrame([(g % 20, g) for g in range(60)], "g int, v int")
    hot = found(hot_keys(big, small, ["g"], *limits))
    assert (hot is None) == (min(limits) == 10**9)
    got = split_join(big, small, ["g"], ["id"], hot, how)
    assert sorted(map(tuple, got.select("g", "id", "score", "v").collect()), key=repr) == sorted(
        map(tuple, big.join(small, "g", how).select("g", "id", "score", "v").collect()), key=repr
    )


def test_hot_keys_are_split_by_rows_and_by_joined_rows(spark):
    big = spark.range(100).select(F.when(F.col("id") < 60, 1).otherwise(F.col("id")).cast("int").alias("g"), "id")
    small = spark.range(50).select(F.lit(70).alias("g"), "id")
    parts = {r["g"]: r["_parts"] for r in hot_keys(big, small, ["g"], hot_rows=20, hot_pairs=1000).collect()}
    assert parts == {1: 3}
    parts = {r["g"]: r["_parts"] for r in hot_keys(big, small, ["g"], hot_rows=1000, hot_pairs=30).collect()}
    assert parts == {1: 2}


def test_split_on_a_part_of_the_keys(spark):
    big = spark.createDataFrame([(i % 3, i % 2, i) for i in range(60)], "g int, h int, id int")
    small = spark.createDataFrame([(g, h, 10 * g + h) for g in range(3) for h in range(2)], "g int, h int, v int")
    hot = spark.createDataFrame([(1, 4)], "g int, _parts int")
    got = split_join(big, small, ["g", "h"], ["id"], hot)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, big.join(small, ["g", "h"]).collect()))


def test_a_hot_key_is_spread_over_parts(spark):
    """Half of all rows have one key; no part gets more than about the limit."""
    big = spark.range(2000).select(F.when(F.col("id") < 1000, 1).otherwise(F.col("id")).alias("g"), "id")
    small = spark.range(2000).select(F.col("id").alias("g"))
    hot = found(hot_keys(big, small, ["g"], 100, 10**9))
    joined = split_join(big, small, ["g"], ["id"], hot)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan and hot.collect()[0]["_parts"] == 10
    sizes = big.filter("g = 1").groupBy(F.pmod(F.xxhash64("id"), F.lit(10))).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 160
    assert joined.count() == 2000


def test_many_hot_keys_are_joined_not_broadcast(spark):
    big = spark.range(3000).selectExpr("id % 5 AS g", "id AS x")
    small = spark.range(50).selectExpr("id % 7 AS g", "id AS y")
    table = hot_keys(big, small, ["g"], 100, 10**9)
    hot = found(table, most=2)
    assert not hot.isLocal() and found(table).isLocal()
    for how in ("inner", "left"):
        got = split_join(big, small, ["g"], ["x"], hot, how)
        assert sorted(map(str, got.collect())) == sorted(map(str, big.join(small, ["g"], how).collect()))
