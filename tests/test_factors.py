import numpy as np
import pytest
from pyspark.sql import functions as F

from lumetra.operators import factors as B


def vectors(spark, ids, matrix):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, matrix)]
    return spark.createDataFrame(rows, "id bigint, features array<double>")


def brute(ids_a, a, ids_b, b, k, keep):
    out = {}
    for i, v in zip(ids_a, a):
        scored = sorted((-round(float(v @ w), 12), int(j)) for j, w in zip(ids_b, b))
        kept = [(j, -s) for s, j in scored if keep(int(i), j, -s)][:k]
        if kept:
            out[int(i)] = kept
    return out


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["id"], []).append((r["other"], r["score"]))
    return {i: sorted(v, key=lambda p: (-p[1], p[0])) for i, v in out.items()}


def same(got, want):
    assert set(got) == set(want)
    for i in want:
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]], i
        assert np.allclose([s for _, s in got[i]], [s for _, s in want[i]], atol=1e-9)


@pytest.mark.parametrize("blocks", [None, (1, 1), (3, 5)])
def test_best_items(spark, blocks):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(30, 6)), rng.normal(size=(50, 6))
    ids_a, ids_b = np.arange(30), np.arange(100, 150)
    got = B.best_partners(vectors(spark, ids_a, a), vectors(spark, ids_b, b), 7, 0.0, True, blocks=blocks)
    same(collected(got), brute(ids_a, a, ids_b, b, 7, lambda i, j, s: s > 0))


def test_similar_items_with_copies_and_a_zero_vector(spark):
    """A third of the vectors are copies of one; ties go to the smaller ids."""
    rng = np.random.default_rng(2)
    m = rng.normal(size=(45, 5))
    m[15:30] = m[15]
    m[44] = 0
    unit = m / np.where((n := np.linalg.norm(m, axis=1, keepdims=True)) == 0, 1, n)
    ids = np.arange(45)
    want = brute(ids[:44], unit[:44], ids[:44], unit[:44], 10, lambda i, j, s: i != j and s >= 0.6)
    for blocks in ((1, 1), (4, 4)):
        v = B.unit_vectors(vectors(spark, ids, m))
        same(collected(B.best_partners(v, v, 10, 0.6, exclude_same=True, blocks=blocks)), want)
    for n in (None, 5):
        same(collected(B.similar_items(vectors(spark, ids, m), n_pivots=n)), want)


def test_filter_then_top_equals_top_then_filter(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(20, 3)), rng.normal(size=(40, 3))
    u, v = vectors(spark, range(20), a), vectors(spark, range(40), b)
    first = collected(B.best_items(u, v, 10))
    then = {}
    for i, pairs in collected(B.best_partners(u, v, 10)).items():
        if kept := [p for p in pairs if p[1] > 0]:
            then[i] = kept
    assert first == then


def test_no_partner_at_all(spark):
    u, v = vectors(spark, [1], [[1.0, 0.0]]), vectors(spark, [2, 3], [[-1.0, 0.0], [0.0, 1.0]])
    assert B.best_items(u, v).count() == 0


def test_lists(spark):
    u, v = vectors(spark, [1], [[1.0, 0.0]]), vectors(spark, [2, 3], [[0.5, 0.0], [2.0, 1.0]])
    row = B.user_lists(B.best_items(u, v)).first()
    assert row["uid"] == 1 and [tuple(r) for r in row["recommendations"]] == [(3, 2.0), (2, 0.5)]
    assert B.item_lists(B.best_items(u, v)).columns == ["mid", "recommendations"]


def test_plan_has_no_product_of_all_pairs(spark):
    v = vectors(spark, range(5), np.eye(5))
    plan = B.similar_items(v)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_vectors(spark):
    none = vectors(spark, [1], [[1.0]]).filter("id > 1")
    assert B.best_items(none, vectors(spark, [2], [[1.0]])).count() == 0
    assert B.similar_items(none).count() == 0


def test_long_items_first_gives_the_same_lists_with_fewer_products(spark):
    """Norms that fall off, copies, zero vectors, and a user whom only short items suit."""
    rng = np.random.default_rng(5)
    users, items = rng.normal(size=(60, 4)), rng.normal(size=(400, 4)) * np.exp(-np.arange(400) / 60)[:, None]
    users[7], items[50], items[60:80] = 0, 0, items[60]
    users[9] = -np.sign(items[:20].sum(axis=0)) * 3
    want = brute(range(60), users, range(400), items, 10, lambda i, j, s: s > 0)
    u, v = vectors(spark, range(60), users), vectors(spark, range(400), items)
    for first in (20, 100, 1000):
        same(collected(B.best_items(u, v, 10, first)), want)
    work = B.scored_pairs(u, v, 10, 20).first()
    assert work["n_pairs"] == 24_000 and work["n_scored"] < 18_000
    assert B.scored_pairs(u, v, 10, 1000).first()["n_scored"] == 24_000


@pytest.mark.parametrize("least", [0.6, -0.5, 1.0])
def test_groups_around_pivots_lose_no_pair(spark, least):
    rng = np.random.default_rng(6)
    m = rng.normal(size=(8, 6))[rng.integers(0, 8, 150)] + rng.normal(size=(150, 6)) * 0.2
    m[100:120] = m[100]
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    want = brute(range(150), unit, range(150), unit, 10, lambda i, j, s: i != j and s >= least)
    for n in (1, 8, 64):
        same(collected(B.similar_items(vectors(spark, range(150), m), min_similarity=least, n_pivots=n)), want)


def test_groups_apart_are_not_compared(spark):
    rng = np.random.default_rng(7)
    m = np.eye(8)[rng.integers(0, 8, 200)] + rng.normal(size=(200, 8)) * 0.02
    work = B.compared_pairs(vectors(spark, range(200), m), 0.6).first()
    assert work["n_pairs"] == 40_000 and work["n_scored"] < 10_000


def test_a_group_of_similar_items_is_one_block(spark, monkeypatch):
    """A vector travels once to a group, not once to each of its parts of ``RIGHT_BLOCK``; the lists are those of all pairs."""
    from lumetra.operators import factors as B

    rows = [(i, [float(i % 7 + 1), float(i % 5), float(i % 3)]) for i in range(60)]
    vectors = spark.createDataFrame(rows, "id bigint, features array<double>")
    want = sorted(B.similar_items(vectors, 3, 0.2, n_pivots=1).collect())
    met, plain = [], B._meet
    monkeypatch.setattr(B, "_meet", lambda left, right, kernel: met.append(left.count()) or plain(left, right, kernel))
    monkeypatch.setattr(B, "RIGHT_BLOCK", 4)
    assert sorted(B.similar_items(vectors, 3, 0.2, n_pivots=2).collect()) == want
    assert met[0] <= 4


@pytest.mark.parametrize("least", [-0.5, 0.3, 1.0])
def test_a_similar_item_travels_once_per_block_and_a_pair_is_scored_once(spark, monkeypatch, least):
    """Many groups that all meet lie in few blocks; chunks, copies and ties change no list."""
    rng = np.random.default_rng(8)
    m = rng.normal(size=(300, 6))
    m[40:60], m[70], m[200:230, :3] = m[40], -m[40], 0
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    want = brute(range(300), unit, range(300), unit, 10, lambda i, j, s: i != j and s >= least)
    sent, plain = [], B._meet

    def counted(left, right, kernel):
        sent.append(sum(side.select(F.size("cells").alias("n")).agg(F.sum("n")).first()[0] or 0 for side in (left, right)))
        return plain(left, right, kernel)

    monkeypatch.setattr(B, "_meet", counted)
    same(collected(B.similar_items(vectors(spark, range(300), m), min_similarity=least, n_pivots=16)), want)
    assert sent == [300]
    monkeypatch.setattr(B, "SIMILAR_CHUNK", 16)
    same(collected(B.similar_items(vectors(spark, range(300), m), min_similarity=least, n_pivots=16)), want)
    assert sent[1] <= 300 * 4


def test_single_precision_is_kept_only_where_it_holds_all_numbers(spark):
    for x, kind in ((0.5, "array<float>"), (0.1, "array<double>")):
        stored = B._stored_lengths(vectors(spark, [1, 2], [[x, 1.0], [2.0, 1.0]]))
        assert dict(stored.dtypes)["features"] == kind and [r["features"] for r in stored.orderBy("id").collect()] == [[x, 1.0], [2.0, 1.0]]
