import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumetra.operators import similarity as S
from lumetra.operators.blocks import best_of_rows, block_count


def sample(seed=3, users=40, items=25, density=0.4):
    """Random ratings with a user who rated everything and an item that everyone rated."""
    rng = random.Random(seed)
    return {
        (u, i): float(rng.randrange(1, 6)) for u in range(users) for i in range(items)
        if u == 0 or i == 0 or rng.random() < density
    }


def brute_pearson(left, right):
    """sim by (a, b) for a of left and b of right, a != b, with a common item; None if undefined."""
    by_user = {}
    for side, data in enumerate((left, right)):
        for (u, i), r in data.items():
            by_user.setdefault((side, u), {})[i] = r
    out = {}
    for (s, a), mine in by_user.items():
        for (t, b), theirs in by_user.items():
            common = sorted(set(mine) & set(theirs))
            if s == 0 and t == 1 and a != b and common:
                x, y = (np.array([d[i] for i in common]) for d in (mine, theirs))
                dx, dy = x - x.mean(), y - y.mean()
                d = math.sqrt((dx @ dx) * (dy @ dy))
                out[a, b] = None if d < 1e-9 else (dx @ dy) / d
    return out


def frame(spark, ratings):
    return spark.createDataFrame([(u, i, r) for (u, i), r in ratings.items()], "user int, item int, rating double")


def same(got, want):
    assert set(got) == set(want)
    for k, v in want.items():
        assert (got[k] is None) == (v is None), k
        assert v is None or abs(got[k] - v) < 1e-9, k


GRIDS = [None, S.Grid(1, 1), S.Grid(7, 6), S.Grid(5, 1, 0), S.Grid(4, 3, 0, 10**6, True), S.Grid(4, 3, 15), S.Grid(4, 1, 30, 100, True), S.Grid(1, 1, None)]


@pytest.mark.parametrize("grid", GRIDS)
def test_pearson_of_all_pairs(spark, grid):
    ratings = sample()
    got = {(r["a"], r["b"]): r["sim"] for r in S.pearson(frame(spark, ratings), "user", "item", grid).collect()}
    same(got, {k: v for k, v in brute_pearson(ratings, ratings).items() if k[0] < k[1]})


def test_item_pearson_is_the_transposed(spark):
    ratings = sample()
    flipped = {(i, u): r for (u, i), r in ratings.items()}
    got = {(r["a"], r["b"]): r["sim"] for r in S.item_pearson(frame(spark, ratings)).collect()}
    same(got, {k: v for k, v in brute_pearson(flipped, flipped).items() if k[0] < k[1]})


def test_more_dimensions_than_one_chunk(monkeypatch):
    monkeypatch.setattr(S, "_CHUNK_DIMS", 4)
    ratings = sample(users=12, items=30)
    left = pa.table({"cells": [[{"k": u, "d": i, "x": int(r)} for (u, i), r in ratings.items()]]})
    a, b, sums = S._tile_sums(left, left.rename_columns(["r_cells"]))
    for i, u in enumerate(a):
        for j, v in enumerate(b):
            common = [k for k in range(30) if (u, k) in ratings and (v, k) in ratings]
            assert sums["n"][i, j] == len(common)
            assert sums["sab_low"][i, j] == sum(ratings[u, k] * ratings[v, k] for k in common) and sums["sab_high"][i, j] == 0
            assert sums["sbb_low"][i, j] == sum(ratings[v, k] ** 2 for k in common)


def test_one_common_item_or_no_variance_is_undefined(spark):
    ratings = {(1, 1): 3.0, (1, 2): 3.0, (1, 3): 3.0, (2, 1): 1.0, (2, 2): 2.0, (2, 3): 4.0, (3, 3): 5.0, (3, 9): 1.0,
               (4, 1): 2.0, (4, 2): 4.0, (4, 3): 8.0, (5, 1): 0.0, (5, 2): 0.0}
    got = {(r["a"], r["b"]): r["sim"] for r in S.user_pearson(frame(spark, ratings)).collect()}
    assert got[1, 2] is None and got[2, 3] is None and got[2, 5] is None
    assert got[2, 4] == 1.0
    assert (3, 5) not in got


@pytest.mark.parametrize("grid", [S.Grid(1, 1), S.Grid(4, 3), S.Grid(5, 1, 0), S.Grid(4, 3, 0), S.Grid(4, 3, 15)])
@pytest.mark.parametrize("n", [1, 3, 100])
def test_nearest(spark, grid, n):
    ratings = sample(seed=9)
    sims = {k: round(v, 12) for k, v in brute_pearson(ratings, ratings).items() if v is not None}
    got = {}
    for r in S.nearest(frame(spark, ratings), n, grid=grid).collect():
        got.setdefault(r["user"], []).append((-r["sim"], r["other"]))
    users = {a for a, _ in sims}
    assert set(got) == users
    for u in users:
        want = sorted((-s, b) for (a, b), s in sims.items() if a == u)[:n]
        assert [b for _, b in sorted(got[u])] == [b for _, b in want]


@pytest.mark.parametrize("grid", [S.Grid(3, 1), S.Grid(3, 1, 0), S.Grid(3, 4, 0), S.Grid(3, 2, 15)])
def test_nearest_among_others(spark, grid):
    full = sample(seed=5)
    reduced = {k: v for k, v in full.items() if k[0] % 2 == 0 and k[1] % 3}
    sims = {k: round(v, 12) for k, v in brute_pearson(reduced, full).items() if v is not None}
    got = {}
    for r in S.nearest(frame(spark, reduced), 4, others=frame(spark, full), grid=grid).collect():
        got.setdefault(r["user"], []).append((-r["sim"], r["other"]))
    for u in {a for a, _ in sims}:
        want = sorted((-s, b) for (a, b), s in sims.items() if a == u)[:4]
        assert [b for _, b in sorted(got[u])] == [b for _, b in want]


def test_identical_raters_do_not_grow_the_output(spark):
    """A third of all users are copies; each still has n neighbours only, the smallest ids."""
    ratings = {(u, i): float((i * 7) % 5 + 1 if u < 30 else (u * i) % 5 + 1) for u in range(90) for i in range(8)}
    got = {}
    for r in S.nearest(frame(spark, ratings), 3, grid=S.Grid(4, 1, light=0)).collect():
        got.setdefault(r["user"], []).append(r["other"])
    assert sorted(got[29]) == [0, 1, 2] and sorted(got[0]) == [1, 2, 3]
    assert max(map(len, got.values())) == 3


def test_best_of_rows():
    score = np.array([[1, 3, 3, 3, -np.inf], [np.nan, 2, -np.inf, -np.inf, 1], [-np.inf] * 5])
    assert best_of_rows(score, 2).tolist() == [
        [False, True, True, False, False], [False, True, False, False, True], [False] * 5
    ]
    assert best_of_rows(score, 9).sum() == 6


def test_block_count():
    assert block_count(0, 1024, 64, 8) == 1
    assert block_count(10, 1024, 64, 8) == 1
    assert block_count(1500, 1024, 64, 8) == 4
    assert block_count(10**6, 1024, 64, 4000) == 977


def test_no_ratings(spark):
    none = frame(spark, {(1, 1): 1.0}).filter("user > 1")
    assert S.user_pearson(none).count() == 0
    assert S.nearest(none, 3).count() == 0
    assert S.nearest(none, 3, grid=S.Grid(2, 2)).count() == 0


@pytest.mark.parametrize("largest", [9, 10**5, S.LARGEST])
def test_block_sums_are_exact(monkeypatch, largest):
    """Products beyond what a double holds, of either sign, in several chunks of dimensions."""
    monkeypatch.setattr(S, "_CHUNK_DIMS", 50)
    rng = random.Random(largest)
    sides = [{(k, d): rng.choice([largest, -largest, rng.randint(-largest, largest)]) for k in range(6) for d in range(130) if rng.random() < 0.9}
             for _ in range(2)]
    left, right = (pa.table({"cells": [[{"k": k, "d": d, "x": x} for (k, d), x in side.items()]]}) for side in sides)
    a, b, sums = S._tile_sums(left, right.rename_columns(["r_cells"]))
    for i, u in enumerate(a):
        for j, v in enumerate(b):
            pairs = [(sides[0][u, d], sides[1][v, d]) for d in range(130) if (u, d) in sides[0] and (v, d) in sides[1]]
            total = lambda m: (int(sums[f"{m}_high"][i, j]) << 32) + int(sums[f"{m}_low"][i, j])  # noqa: E731, B023
            assert (sums["n"][i, j], sums["sa"][i, j], sums["sb"][i, j]) == (len(pairs), sum(x for x, _ in pairs), sum(y for _, y in pairs))
            assert total("saa") == sum(x * x for x, _ in pairs) and total("sbb") == sum(y * y for _, y in pairs)
            assert total("sab") == sum(x * y for x, y in pairs)


@pytest.mark.parametrize("odd", [0, 1])
def test_close_ratings_tie_exactly_on_any_grid(spark, odd):
    """Two common ratings correlate perfectly, however close and large they are; a rating with five decimals changes nothing."""
    rng = random.Random(8)
    ratings = {}
    for u in range(40):
        first = rng.randrange(90_000, 91_000)
        ratings[u, 0], ratings[u, 1] = first / 100, (first + rng.choice([1, 2, 30])) / 100
    if odd:
        ratings[99, 7] = 0.12345
    df = frame(spark, ratings)
    for grid in (None, S.Grid(3, 1), S.Grid(3, 1, 0), S.Grid(6, 2, 0), S.Grid(6, 2, 0, 10, True), S.Grid(6, 2, 1)):
        got = {}
        for r in S.nearest(df, 3, grid=grid).collect():
            assert r["sim"] == 1.0
            got.setdefault(r["user"], []).append(r["other"])
        assert sorted(got[30]) == [0, 1, 2] and sorted(got[1]) == [0, 2, 3]


def test_a_million_co_ratings_are_exact(spark):
    """Three keys with a million common dimensions, large ratings that differ in the last place only."""
    n = 1_000_000
    rows = spark.range(n).selectExpr("cast(id AS INT) AS item", "id % 7 AS r").selectExpr(
        "item", "inline(array(struct(1 AS user, 3000 + r / 1e6D AS rating), struct(2 AS user, 3000 - r / 1e6D AS rating),"
        " struct(3 AS user, 3000 + (r % 2) / 1e6D AS rating)))"
    )
    x = {1: 3_000_000_000, 2: 3_000_000_000, 3: 3_000_000_000}
    per = [n // 7 + (1 if r < n % 7 else 0) for r in range(7)]
    value = {1: lambda r: x[1] + r, 2: lambda r: x[2] - r, 3: lambda r: x[3] + r % 2}
    want = {}
    for a, b in ((1, 2), (1, 3), (2, 3)):
        s = lambda f: sum(c * f(value[a](r), value[b](r)) for r, c in enumerate(per))  # noqa: E731, B023
        want[a, b] = (n, s(lambda p, q: p), s(lambda p, q: q), s(lambda p, q: p * p), s(lambda p, q: q * q), s(lambda p, q: p * q))
    for grid in (None, S.Grid(1, 1, None), S.Grid(1, 245, 0)):
        got = {(r["a"], r["b"]): (r["n"], r["sa"], r["sb"], int(r["saa"]), int(r["sbb"]), int(r["sab"]))
               for r in S.co_moments(rows, "user", "item", grid=grid).collect()}
        assert got == want
    sims = {(r["a"], r["b"]): r["sim"] for r in S.pearson(rows, "user", "item", S.Grid(1, 1, None)).collect()}
    assert sims[1, 2] == -1.0


def test_a_rating_beyond_the_declared_steps_is_an_error_and_fewer_places_help(spark):
    ratings = frame(spark, {(1, 1): 9000.5, (2, 1): 1.0, (1, 2): 2.0, (2, 2): 3.0})
    with pytest.raises(Exception, match="declare fewer places"):
        S.user_pearson(ratings).collect()
    assert S.pearson(ratings, "user", "item", places=2).first()["sim"] == -1.0


def test_plain_sums_and_halves_agree(spark):
    """Whether sums are plain and ratings divided by a step changes no moment."""
    df = frame(spark, {k: v / 4 for k, v in sample(seed=21).items()})
    plain = S.tile_grid(df, "user", "item")
    assert plain.plain and plain.step == 10**4
    assert not S.tile_grid(df.withColumn("rating", df.rating * 1000 + 1e-6), "user", "item").plain
    want = sorted(S.co_moments(df, "user", "item", grid=S.Grid(4, 3, 0)).collect())
    for grid in (plain, plain._replace(light=0, dims=2, keys=3), plain._replace(light=20), S.Grid(2, 1, 0)):
        assert sorted(S.co_moments(df, "user", "item", grid=grid).collect()) == want


@pytest.mark.parametrize("share", [1, 20])
def test_asked_pairs_alone(spark, share):
    """Few asked pairs are looked up, many are picked; both are those of all pairs."""
    ratings = sample(seed=22)
    df = frame(spark, ratings)
    pairs = S.user_pearson(df)
    asked = pairs.where(F.col("a") % share == 0).select("a", "b")
    got = sorted(S.pearson_of_pairs(asked, df, "user", "item", hot_rows=10, hot_pairs=100).collect(), key=lambda r: r[:2])
    assert got == sorted(pairs.where(F.col("a") % share == 0).collect(), key=lambda r: r[:2])


@pytest.mark.parametrize("kind, step, plain", [("tinyint", 10**6, True), ("bigint", 1, False)])
def test_unpacked_co_ratings_are_all_pairs(spark, kind, step, plain):
    """Packed lists of raters give the moments of the join, of one table and of two."""
    ratings = sample(seed=23)
    df, few = frame(spark, ratings), frame(spark, {k: v for k, v in ratings.items() if k[0] % 3 == 0})
    odd = df.unionByName(spark.createDataFrame([(None, 1, 2.0), (3, None, 2.0), (4, 1, None)], df.schema))
    joined = S.Grid(1, 1, None, step, plain)
    for light in (None, 15):
        packed, rows = joined._replace(tasks=3, kind=kind, light=light), odd if light is None else df
        assert sorted(S.co_moments(rows, "user", "item", grid=packed).collect()) == sorted(S.co_moments(df, "user", "item", grid=joined).collect())
        got = sorted(S.co_moments(few, "user", "item", rows, packed).collect())
        assert got == sorted(S.co_moments(few, "user", "item", df, joined).collect())


def test_many_keys_are_summed_without_a_shuffle_of_pairs(spark):
    df = spark.range(9000).selectExpr("cast(id % 3000 AS INT) AS user", "cast(id * 7 % 1501 AS INT) AS item", "cast(id % 5 AS DOUBLE) AS rating")
    df = df.dropDuplicates(["user", "item"])
    grid = S.tile_grid(df, "user", "item")
    assert grid.tasks and grid.kind == "tinyint" and grid.light is None
    plan = S.pearson(df, "user", "item", grid._replace(tasks=4))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(a" not in plan and "hashpartitioning(h" in plan
    joined = sorted(S.pearson(df, "user", "item", grid._replace(tasks=0)).collect(), key=lambda r: r[:2])
    assert joined and sorted(S.user_pearson(df).collect(), key=lambda r: r[:2]) == joined


@pytest.mark.parametrize("seed, shift, users, values", [(31, 0.0, 90, 5), (32, 500.0, 90, 3), (33, 0.0, 60, 1), (34, -3.0, 90, 1000)])
def test_wide_blocks_find_the_same_nearest(spark, monkeypatch, seed, shift, users, values):
    """Screening in single precision loses no partner, with ties, large or constant ratings, in one or two tables."""
    monkeypatch.setattr(S, "_CHUNK_KEYS", 16)
    rng = random.Random(seed)
    ratings = {(u, i): shift + rng.randrange(values) / 100 for u in range(users) for i in range(12) if rng.random() < 0.6}
    df, few = frame(spark, ratings), frame(spark, {k: v for k, v in ratings.items() if k[0] % 3 == 0})
    narrow = S.Grid(5, 1, 0, 10**4, True, 0, "int")
    for wide in (1, 3):
        for others in (None, df):
            left = df if others is None else few
            want = sorted(S.nearest(left, 4, others=others, grid=narrow).collect())
            assert sorted(S.nearest(left, 4, others=others, grid=narrow._replace(wide=wide)).collect()) == want


def test_many_keys_meet_in_few_blocks(spark):
    """A key goes to a block of tens of thousands of others, not of a thousand."""
    df = spark.range(300 * 300).selectExpr("cast(id / 300 AS INT) AS item", "cast(id % 300 AS INT) AS user", "cast(id % 7 AS DOUBLE) AS rating")
    more = df.unionByName(spark.range(300, 60_000).selectExpr("0 AS item", "cast(id AS INT) AS user", "1D AS rating"))
    grid = S.tile_grid(more, "user", "item")
    assert grid.plain and grid.light == 0 and grid.dims == 1 and grid.keys > 50 and grid.wide < 10


def test_screen_keeps_every_pair_that_reaches():
    rng = np.random.default_rng(5)
    for spread in (1, 3, 10**6):
        m = (rng.random((200, 40)) < 0.5) * 1.0
        x = (5_000_000 + rng.integers(0, spread + 1, m.shape)) * m
        sim = S._similarities(S._sums_of(x, m, x, m))
        for least in (0.3, 0.9, 1 - 1e-12):
            kept = S._Screen([(x, m), (x, m)], 40).pairs(slice(0, 200), slice(0, 200), np.full((200, 1), least))
            assert kept[sim >= least].all()


@pytest.mark.parametrize("shift", [0.0, -3.0])
def test_wide_blocks_pass_on_all_pairs(spark, monkeypatch, shift):
    """The moments of the tiles, of one table and of two, also with rows without key, dimension or rating."""
    monkeypatch.setattr(S, "_CHUNK_KEYS", 16)
    rng = random.Random(41)
    ratings = {(u, i): shift + rng.randrange(700) / 100 for u in range(90) for i in range(12) if rng.random() < 0.4}
    df, few = frame(spark, ratings), frame(spark, {k: v for k, v in ratings.items() if k[0] % 3 == 0})
    odd = df.unionByName(spark.createDataFrame([(None, 1, 2.0), (3, None, 2.0), (4, 99, None)], df.schema))
    for keys in (1, 4):
        tiles = S.Grid(keys, 1, 0, 10**4, True, 0, "int")
        wide = tiles._replace(wide=1)
        assert sorted(S.co_moments(odd, "user", "item", grid=wide).collect()) == sorted(S.co_moments(df, "user", "item", grid=tiles).collect())
        got = sorted(S.co_moments(few, "user", "item", odd, wide).collect())
        assert got == sorted(S.co_moments(few, "user", "item", df, tiles).collect())


def test_all_pairs_of_many_keys_go_through_few_blocks(spark):
    """Each key of 20,000 is sent, packed, to some blocks of thousands of keys, not to twenty of a thousand."""
    df = spark.range(20_000 * 3).selectExpr("cast(id % 20000 AS INT) AS user", "cast(id div 20000 AS INT) AS item", "cast(id % 7 AS DOUBLE) AS rating")
    grid = S.tile_grid(df, "user", "item")
    assert grid.keys > 15 and grid.light == 0 and grid.dims == 1
    plan = S.pearson(df, "user", "item", grid)._jdf.queryExecution().analyzed().toString()
    assert "FlatMapGroupsInArrow" in plan and "FlatMapCoGroupsInArrow" not in plan and "collect_list(struct(k" not in plan


def test_sums_of_few_dimensions_are_plain_however_many_the_ratings(spark):
    """Ratings up to 2 ** 25 in 2 dimensions reach 2 ** 51, though 600 of them squared and summed pass 2 ** 53."""
    df = spark.range(600).selectExpr("cast(id div 2 AS INT) AS user", "cast(id % 2 AS INT) AS item", "cast(pow(2, 25) - id % 7 AS DOUBLE) AS rating")
    grid = S.tile_grid(df, "user", "item", places=0)
    assert grid.plain and grid.wide
    halves = sorted(S.co_moments(df, "user", "item", grid=grid._replace(plain=False, wide=0), places=0).collect())
    assert halves and sorted(S.co_moments(df, "user", "item", grid=grid, places=0).collect()) == halves


def test_only_whole_lists_leave_the_search_for_the_nearest(spark, monkeypatch):
    """A key's list is found in one task, not one list per block of others; the lists are those of the tiles."""
    monkeypatch.setattr(S, "_CHUNK_KEYS", 16)
    rng = random.Random(43)
    df = frame(spark, {(u, i): rng.randrange(10**5) / 100 for u in range(200) for i in range(20) if rng.random() < 0.9})
    tiles, left, plain = S.Grid(4, 1, 0, 10**4, True, 0, "int"), [], S.top_k
    monkeypatch.setattr(S, "top_k", lambda rows, *more: left.append(rows.count()) or plain(rows, *more))
    want = sorted(S.nearest(df, 5, grid=tiles).collect())
    assert sorted(S.nearest(df, 5, grid=tiles._replace(wide=4)).collect()) == want
    assert left[1] == 200 * 5


def test_a_block_of_keys_holds_no_more_than_a_few_matrices():
    """8,192 keys of 100 dimensions with 100 partners each, met by 4,096 others, take less than 150 MB at their peak."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(9)

    def keys(n, start):
        d = [np.flatnonzero(rng.random(100) < 0.5).astype(np.int32) for _ in range(n)]
        return pa.table({"k": np.arange(start, start + n), "d": pa.array(d), "x": pa.array([rng.integers(0, 50_000, len(z)).astype(np.int32) for z in d])})

    own, others = keys(8192, 0), keys(4096, 10_000)
    tracemalloc.start()
    block = S._Nearest(own, 100)
    block.meet(others)
    assert sum(len(b) for b in block.found()) >= 8192 * 100
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150_000_000


def _many_keys(spark):
    df = spark.range(9000).selectExpr("cast(id * 7919 % 3000 AS INT) AS user", "cast(id * 7 % 1501 AS INT) AS item", "cast(id % 5 AS DOUBLE) AS rating")
    return df.dropDuplicates(["user", "item"])


def test_pairs_of_one_co_rating_do_not_reach_the_search_for_the_nearest(spark, monkeypatch):
    """They have no similarity; of many sparse keys nearly all pairs are such."""
    rng = random.Random(44)
    df = frame(spark, {(rng.randrange(2500), rng.randrange(600)): rng.randrange(5) * 1.0 for _ in range(12_000)})
    least, plain = [], S._similarity
    grid = S.tile_grid(df, "user", "item")._replace(tasks=3)
    joined = grid._replace(tasks=0)
    monkeypatch.setattr(S, "_similarity", lambda sums, grid: least.append(sums.agg(F.min("n")).first()[0]) or plain(sums, grid))
    for others in (None, df.filter("user % 2 = 0")):
        want = sorted(S.nearest(df, 3, others=others, grid=joined).collect())
        assert want and sorted(S.nearest(df, 3, others=others, grid=grid).collect()) == want
    assert least[1] >= 2 and least[3] >= 2
    assert S.pearson(df, "user", "item", grid).filter("n = 1").count() > 0


def test_packed_lists_are_summed_in_small_parts(spark, monkeypatch):
    """Parts of the keys, and of the partners of a key with very many, sum to the same; ids may be large or negative."""
    df = _many_keys(spark).selectExpr("cast(user AS BIGINT) * 3000000000000000 - 4000000000000000000 AS user", "item", "rating - 2 AS rating")
    few = df.filter("item % 3 = 0")
    for grid in (S.Grid(1, 1, None, 10**6, True, 2, "tinyint"), S.Grid(1, 1, None, 1, False, 2, "bigint")):
        wants = [sorted(S.co_moments(df, "user", "item", right, grid._replace(tasks=0)).collect()) for right in (None, few)]
        with monkeypatch.context() as m:
            m.setattr(S, "CO_RATINGS", 64)
            for right, want in zip((None, few), wants):
                assert want and sorted(S.co_moments(df, "user", "item", right, grid).collect()) == want


def test_a_co_rating_travels_in_few_bytes():
    """An id among 7 million and a small number, sent to another key, take less than four bytes."""
    import pyarrow as pa

    rng = np.random.default_rng(10)
    ids = [np.sort(rng.choice(7_200_000, 40, replace=False)).astype(np.int32) for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({"k": pa.array(ids), "x": pa.array([rng.integers(1, 51, 40).astype(np.int8) for _ in ids])})
    blobs = [b for out in S._sent_lists(True, 20)(iter([batch])) for b in out.column("blob").to_pylist()]
    assert sum(map(len, blobs)) < 4 * 2000 * 40 * 39 / 2
