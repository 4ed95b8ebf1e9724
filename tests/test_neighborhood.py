import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from lumetra.operators import evaluate as E
from lumetra.operators import neighborhood as N
from lumetra.operators import similarity as S
from tests.test_similarity import brute_pearson, frame, sample


def brute_neighbours(left, right, n):
    sims = {k: round(v, 12) for k, v in brute_pearson(left, right).items() if v is not None}
    out = {}
    for u in {a for a, _ in sims}:
        out[u] = [(b, -s) for s, b in sorted((-s, b) for (a, b), s in sims.items() if a == u)[:n]]
    return out


def brute_estimates(neighbours, ratings):
    low, high = min(ratings.values()), max(ratings.values())
    out = {}
    for u, near in neighbours.items():
        for i in {i for _, i in ratings}:
            votes = [(s, ratings[v, i]) for v, s in near if (v, i) in ratings]
            total = sum(s for s, _ in votes)
            if len(votes) >= 2 and total != 0:
                out[u, i] = min(max(sum(s * r for s, r in votes) / total, low), high)
    return out


def brute_recommend(neighbours, ratings, seen, k):
    best = {}
    for (u, i), p in brute_estimates(neighbours, ratings).items():
        if (u, i) not in seen:
            best.setdefault(u, []).append((-round(p, 9), i))
    return {u: [i for _, i in sorted(v)[:k]] for u, v in best.items()}


def by_user(rows):
    out = {}
    for r in rows:
        out.setdefault(r["user"], []).append((-round(r["prediction"], 9), r["item"]))
    return {u: [i for _, i in sorted(v)] for u, v in out.items()}


@pytest.mark.parametrize("n", [4, 100])
def test_recommend_for_all_users(spark, n):
    ratings = sample(seed=11)
    df = frame(spark, ratings)
    got = by_user(N.recommend(S.nearest(df, n), df, 5).collect())
    assert got == brute_recommend(brute_neighbours(ratings, ratings, n), ratings, ratings, 5)


def test_recommend_for_one_user(spark):
    df = frame(spark, sample(seed=11))
    neighbours = S.nearest(df, 10)
    everyone = N.recommend(neighbours, df, 10).filter("user = 5").collect()
    assert N.recommend(neighbours, df, 10, for_users=F.col("user") == 5).collect() == everyone


@pytest.mark.parametrize("limits", [(5, 10**9), (10**9, 20)])
def test_estimates_do_not_depend_on_splitting(spark, limits):
    df = frame(spark, sample(seed=12))
    neighbours = S.nearest(df, 6)
    plain = {(r["user"], r["item"]): r["prediction"] for r in N.estimates(neighbours, df).collect()}
    split = {(r["user"], r["item"]): r["prediction"] for r in N.estimates(neighbours, df, *limits).collect()}
    assert set(plain) == set(split)
    assert all(math.isclose(plain[k], split[k], abs_tol=1e-9) for k in plain)


def test_one_vote_is_not_enough_and_estimates_stay_in_range(spark):
    df = frame(spark, {(1, 1): 5.0, (2, 1): 1.0, (3, 2): 3.0, (2, 2): 4.0, (3, 1): 2.0, (2, 3): 9.0})
    near = spark.createDataFrame([(1, 2, 0.9), (1, 3, -0.8)], "user bigint, other bigint, sim double")
    got = {(r["user"], r["item"]): r["prediction"] for r in N.estimates(near, df).collect()}
    assert got == {(1, 2): 9.0, (1, 1): 1.0}


@pytest.mark.parametrize("limits", [(10**6, 10**8), (3, 10**8), (10**6, 5)])
def test_recommended_because(spark, limits):
    ratings = sample(seed=13, users=20, items=12)
    flipped = {(i, u): r for (u, i), r in ratings.items()}
    sims = {k: v for k, v in brute_pearson(flipped, flipped).items() if v is not None}
    df = frame(spark, ratings)
    targets = [(u, i) for u in range(20) for i in (0, 5, 7)]
    got = {}
    pairs = S.both_ways(S.item_pearson(df))
    wanted = spark.createDataFrame(targets, "user int, item int")
    asked = N.recommended_because(wanted, df, None, 4, *limits).collect()
    listed = N.recommended_because(wanted, df, pairs, 4, *limits).collect()
    assert sorted(asked) == sorted(listed)
    for r in listed:
        got.setdefault((r["user"], r["item"]), []).append((-round(r["score"], 9), r["because"]))
    for u, i in targets:
        own = [(-round((1 + sims[i, j]) * r, 9), j) for (v, j), r in ratings.items() if v == u and j != i and (i, j) in sims]
        assert sorted(got.get((u, i), [])) == sorted(own)[:4]


def test_holdout_errors(spark):
    ratings = sample(seed=14, users=30, items=30)
    bucket = {k: (k[0] * 7919 + k[1] * 104729) % 100 for k in ratings}
    train = {k: r for k, r in ratings.items() if bucket[k] < 70}
    test = {k: r for k, r in ratings.items() if bucket[k] >= 70}
    predicted = brute_estimates(brute_neighbours(train, train, 2), train)
    errors = [predicted[k] - r for k, r in test.items() if k in predicted]
    row = E.holdout_errors(frame(spark, ratings)).first()
    assert row["n_scored"] == len(errors) > 0
    assert math.isclose(row["mae"], statistics.fmean(map(abs, errors)), abs_tol=1e-9)
    assert math.isclose(row["rmse"], math.sqrt(statistics.fmean(e * e for e in errors)), abs_tol=1e-9)


def test_relevance_threshold(spark):
    got = {r["user"]: r for r in E.relevance_threshold(frame(spark, {(1, 1): 2.0, (1, 2): 4.0, (2, 1): 3.0})).collect()}
    assert math.isclose(got[1]["threshold"], 3 + math.sqrt(2))
    assert got[2]["threshold"] == float("-inf")


def test_precision_recall_one_user_at_a_time(spark):
    rng = random.Random(4)
    ratings = {(u, i): rng.randrange(1, 500) / 10 for u in range(25) for i in range(30) if rng.random() < 0.5 or u == 0}
    ratings |= {(99, i): 1.0 + i for i in range(3)}
    precision, recall, recommended, hits = [], [], 0, 0
    for u in sorted({u for u, _ in ratings}):
        mine = {i: r for (v, i), r in ratings.items() if v == u}
        limit = statistics.fmean(mine.values()) + statistics.stdev(mine.values())
        relevant = {i for _, i in sorted((-r, i) for i, r in mine.items())[:4] if mine[i] >= limit}
        if not relevant or len(mine) < 8:
            continue
        reduced = {k: r for k, r in ratings.items() if k[0] == u and k[1] not in relevant}
        near = brute_neighbours(reduced, ratings, 4)
        got = brute_recommend(near, ratings, reduced, 4).get(u, [])
        hit = len(relevant & set(got))
        recommended, hits = recommended + len(got), hits + hit
        recall.append(hit / len(relevant))
        if got:
            precision.append(hit / len(got))
    row = E.precision_recall(frame(spark, ratings)).first()
    assert (row["n_users"], row["n_recommended"], row["n_hits"]) == (len(recall), recommended, hits)
    assert math.isclose(row["precision"], statistics.fmean(precision), abs_tol=1e-9)
    assert math.isclose(row["recall"], statistics.fmean(recall), abs_tol=1e-9)
