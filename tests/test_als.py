import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumetra.operators import als as A
from lumetra.operators import ratings as R
from lumetra.plans.recommend_job import run_recommendation_job, run_similarity_job
from lumetra.sources import jdbc
from lumetra.plans import recommend_job


def low_rank(users=40, items=30, density=0.6, seed=1):
    rng = random.Random(seed)
    p = [[rng.uniform(0.5, 1.5) for _ in range(2)] for _ in range(users)]
    q = [[rng.uniform(0.5, 1.5) for _ in range(2)] for _ in range(items)]
    return {(u, i): sum(a * b for a, b in zip(p[u], q[i])) for u in range(users) for i in range(items) if rng.random() < density}


@pytest.fixture(scope="module")
def ratings():
    return low_rank()


@pytest.fixture(scope="module")
def frame(spark, ratings):
    return spark.createDataFrame([(u, i, r) for (u, i), r in ratings.items()], "user int, item int, rating double").persist()


@pytest.fixture(scope="module")
def model(frame):
    return A.fit(frame, A.AlsParams(rank=3, reg=0.05, max_iter=8), blocks=2)


def factors(df):
    return {r["id"]: np.array(r["features"], dtype=float) for r in df.collect()}


def test_user_factors_solve_their_least_squares(model, ratings):
    """The last half-step fits each user exactly, with the regularisation scaled by the number of ratings."""
    p, q = factors(model.userFactors), factors(model.itemFactors)
    for u in p:
        rows = [(q[i], r) for (v, i), r in ratings.items() if v == u]
        lhs = sum(np.outer(f, f) for f, _ in rows) + 0.05 * len(rows) * np.eye(3)
        assert np.allclose(np.linalg.solve(lhs, sum(f * r for f, r in rows)), p[u], atol=1e-3)


def test_predict_and_rmse(spark, model, frame, ratings):
    p, q = factors(model.userFactors), factors(model.itemFactors)
    want = math.sqrt(np.mean([(p[u] @ q[i] - r) ** 2 for (u, i), r in ratings.items()]))
    assert math.isclose(A.rmse(model, frame), want, abs_tol=1e-5)
    assert want < 0.2
    unknown = spark.createDataFrame([(0, 0), (9999, 0), (0, 9999)], "user int, item int")
    assert A.predict(model, unknown).count() == 1
    assert math.isnan(A.rmse(model, frame.filter("user < 0")))


def test_recommendations_equal_the_models_own(model):
    own = {
        r["user"]: [(x["item"], x["rating"]) for x in r["recommendations"]] for r in model.recommendForAllUsers(5).collect()
    }
    got = {}
    for r in A.recommend_for_users(model, 5).collect():
        got.setdefault(r["id"], []).append((r["other"], r["score"]))
    assert set(got) == set(own)
    for u in own:
        mine = sorted(got[u], key=lambda t: -t[1])
        assert [i for i, _ in mine] == [i for i, _ in own[u]]
        assert np.allclose([s for _, s in mine], [s for _, s in own[u]], atol=1e-4)


def test_similar_items_of_a_model(model):
    q = factors(model.itemFactors)
    for r in A.item_similarity(model, 3, 0.9).collect():
        a, b = q[r["id"]], q[r["other"]]
        assert math.isclose(r["score"], a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs_tol=1e-6)
        assert r["score"] >= 0.9 and r["id"] != r["other"]


def test_grid_search(frame):
    parts = R.split_parts(frame, R.SPLIT_60_20_20)
    train, validation = (parts.filter(F.col("part") == p).drop("part") for p in ("train", "validation"))
    found = A.grid_search(train, validation, ranks=[1, 2], regs=[0.01, 5.0], iters=[2], parallelism=2)
    board = found.leaderboard.orderBy("ord").collect()
    assert [(r["rank"], r["reg"], r["max_iter"]) for r in board] == [(1, 0.01, 2), (1, 5.0, 2), (2, 0.01, 2), (2, 5.0, 2)]
    best = [r for r in board if r["is_best"]]
    assert len(best) == 1 and best[0]["validation_rmse"] == min(r["validation_rmse"] for r in board) == found.validation_rmse
    assert (found.best.rank, found.best.reg) == (best[0]["rank"], best[0]["reg"])
    with pytest.raises(ValueError, match="known user"):
        A.grid_search(train, validation.filter("user < 0"), ranks=[1], regs=[0.1], iters=[1])


def test_factor_blocks():
    assert A.factor_blocks(0) == 1
    assert A.factor_blocks(60_000) == 3
    for n in (10**9, 10**11, 10**12):
        blocks = A.factor_blocks(n)
        assert blocks**2 <= n / 100 and n / blocks <= A.MOST_PER_BLOCK


def test_no_more_blocks_than_users_or_items(spark):
    rows = spark.range(200_000).selectExpr("cast(id % 50000 AS INT) AS user", "cast(id % 3 AS INT) AS item", "1.0 AS rating")
    assert A.block_grid(rows) == (8, 3)


def test_a_hundred_items_make_few_blocks(spark):
    """A user's factor goes to the blocks of its items, however many ratings there are; all items still get a factor."""
    rows = spark.range(400_000).selectExpr("cast(id % 4000 AS INT) AS user", "cast(id / 4000 AS INT) AS item", "1D + id % 5 AS rating")
    assert A.factor_blocks(400_000) > 8 and A.block_grid(rows) == (16, 8)


def test_default_grid_has_sixteen_fits():
    assert len(A.GRID_RANKS) * len(A.GRID_REGS) * len(A.GRID_ITERS) == 16


def test_recommendation_job(spark, frame, monkeypatch):
    sent = []
    monkeypatch.setattr(recommend_job, "append_jdbc", lambda df, target: sent.append((df.count(), target.table)))
    source = frame.select(F.col("user").alias("uid"), F.col("item").alias("song"), "rating")
    bad = spark.createDataFrame([("x", "1", "1.0")], "uid string, song string, rating string")
    source = source.select(*[F.col(c).cast("string") for c in source.columns]).unionByName(bad)
    report = run_recommendation_job(
        spark, source, "rec_out", top_n=4, ranks=[2], regs=[0.05], iters=[3], jdbc=jdbc.JdbcTarget("jdbc:x", "rec_genre")
    )
    table = spark.table("rec_out")
    assert table.columns == ["id", "uid", "song", "predict"]
    rows = table.orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(1, 161))
    keys = [(r["uid"], -r["predict"], r["song"]) for r in rows]
    assert keys == sorted(keys)
    assert sent == [(160, "rec_genre")]
    assert report.bad_ratings == 1 and report.profile.first()["n_users"] == 40
    assert report.test_rmse < report.baseline_rmse and report.improvement_percent > 0
    with pytest.raises(ValueError, match="list length"):
        run_recommendation_job(spark, source, "rec_out")


def test_similarity_job(spark, frame):
    source = frame.toDF("user_id", "track_id", "score")
    lists = run_similarity_job(spark, source, limit=200, params=A.AlsParams(4, 0.01, 3))
    users, items = lists.users.collect(), lists.items.collect()
    assert users and all(0 < len(r["recommendations"]) <= 10 for r in users)
    assert all(x["rating"] > 0 for r in users for x in r["recommendations"])
    assert all(x["rating"] >= 0.6 and x["product"] != r["mid"] for r in items for x in r["recommendations"])
