import math
import random

import pytest

from lumetra.operators import placetree
from lumetra.operators.geo import EARTH_KM, nearest_place


def km(lon1, lat1, lon2, lat2):
    p, q = math.radians(lat1), math.radians(lat2)
    a = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_KM * math.asin(math.sqrt(min(1.0, a)))


def check(spark, points, places, max_km, **options):
    p = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id int, lon double, lat double")
    q = spark.createDataFrame(
        [(i, float(x), float(y), f"a{i}") for i, (x, y) in enumerate(places)], "place_id int, lon double, lat double, address string"
    )
    got = {r["id"]: r["address"] for r in nearest_place(p, q, max_km, **options).collect()}
    want = {}
    for i, (x, y) in enumerate(points):
        near = min((round(km(x, y, u, v), 9), j) for j, (u, v) in enumerate(places))
        want[i] = f"a{near[1]}" if near[0] <= max_km else None
    assert got == want
    return got


@pytest.mark.parametrize("max_km", [5, 60, 700])
def test_around_a_city(spark, max_km):
    rng = random.Random(1)
    points = [(116 + rng.uniform(-1, 1), 40 + rng.uniform(-1, 1)) for _ in range(200)]
    places = [(116 + rng.uniform(-1, 1), 40 + rng.uniform(-1, 1)) for _ in range(60)]
    got = check(spark, points, places, max_km)
    assert got == check(spark, points, places, max_km, small_places=0)
    assert got == check(spark, points, places, max_km, small_places=0, hot_rows=7)
    assert max_km > 5 or None in got.values()


@pytest.mark.parametrize("small", [0, 1000])
@pytest.mark.parametrize("max_km", [50, 400])
def test_date_line_poles_and_the_whole_world(spark, max_km, small):
    rng = random.Random(2)
    def anywhere(n):
        out = [(rng.choice([-180, -179.9, 179.9, 180, rng.uniform(-180, 180)]), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(n)]
        return out + [(rng.uniform(-180, 180), s * rng.uniform(78, 90)) for s in (1, -1) for _ in range(n // 2)]
    check(spark, anywhere(120), anywhere(150), max_km, small_places=small)


def test_places_at_one_spot_count_once_and_ties_go_to_the_smaller_id(spark):
    got = check(spark, [(10, 50)] * 5 + [(10, 51)], [(10.1, 50)] * 50 + [(9.9, 50)], 30)
    assert got[0] == "a0" and got[5] is None


def test_few_places_leave_the_points_where_they_are(spark):
    points = spark.range(10).selectExpr("id", "cast(id AS DOUBLE) AS lon", "1D AS lat")
    places = spark.range(3).selectExpr("id AS place_id", "cast(id AS DOUBLE) AS lon", "1D AS lat", "'a' AS address")
    plan = nearest_place(points, places, 30)._jdf.queryExecution().executedPlan().toString()
    left = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in left and "Exchange hashpartitioning" not in left


def test_no_points_or_no_places(spark):
    points = spark.range(2).selectExpr("id", "1D AS lon", "1D AS lat")
    places = spark.range(2).selectExpr("id AS place_id", "1D AS lon", "1D AS lat", "'a' AS address")
    assert nearest_place(points.filter("id < 0"), places, 30).count() == 0
    assert [r["address"] for r in nearest_place(points, places.filter("place_id < 0"), 30).collect()] == [None, None]


@pytest.mark.parametrize("options", [{}, {"small_places": 0}, {"small_places": 0, "hot_rows": 50}])
@pytest.mark.parametrize("max_km", [0.2, 30, 3000])
def test_places_at_city_density(spark, max_km, options):
    """One dense town, a few villages, copies of spots, and points in the town, far off and on places."""
    rng = random.Random(4)
    town = [(116 + rng.gauss(0, 0.01), 40 + rng.gauss(0, 0.01)) for _ in range(900)]
    places = town + [(116 + rng.uniform(-2, 2), 40 + rng.uniform(-2, 2)) for _ in range(60)] + town[:100]
    points = [(116 + rng.gauss(0, 0.02), 40 + rng.gauss(0, 0.02)) for _ in range(150)]
    points += [(116 + rng.uniform(-2, 2), 40 + rng.uniform(-2, 2)) for _ in range(100)] + town[:20] + [(0, 0), (-64, -40)]
    check(spark, points, places, max_km, **options)


def test_points_without_coordinates_and_repeated_points(spark):
    points = spark.createDataFrame([(1, 1.0, 1.0), (1, 1.0, 1.0), (2, None, 1.0), (3, 9.0, 9.0)], "id int, lon double, lat double")
    places = spark.range(200).selectExpr("id AS place_id", "1D + id / 1e5 AS lon", "1D AS lat", "concat('a', id) AS address")
    got = sorted((r["id"], r["address"]) for r in nearest_place(points, places, 30).collect())
    assert got == [(1, "a0"), (1, "a0"), (2, None), (3, None)] or [x[1] for x in got] == ["a0", "a0", None, None]


@pytest.mark.parametrize("max_km", [0.2, 5, 3000])
def test_a_point_is_moved_to_the_cells_that_may_hold_its_place_alone(spark, monkeypatch, max_km):
    """Many small cells, some split by point: results as by brute force, and hardly more rows kept than there are points and places."""
    monkeypatch.setattr(placetree, "CELL", 8, raising=False)
    monkeypatch.setattr(placetree, "GROUP", 20, raising=False)
    kept = []

    def stored(df, name="stage", store=placetree.stored):
        out = store(df, name)
        kept.append(out.count())
        return out

    monkeypatch.setattr(placetree, "stored", stored)
    rng = random.Random(5)
    town = [(117.2 + rng.random() / 10, 31.8 + rng.random() / 10) for _ in range(300)]
    places = town + town[:50] + [(117 + i / 10, 31.5) for i in range(7)] + [(-63, -31.8), (179.99, 0), (-179.99, 0.01)]
    points = [(117.15 + rng.random() / 5, 31.75 + rng.random() / 5) for _ in range(500)] + town[:20] + [(180, 0), (0, 90), (118, 33)]
    check(spark, points, places, max_km, small_places=0)
    assert sum(kept) <= 2 * len(points) + 2 * len(places)


def test_repeated_points_near_the_edge_of_a_cell(spark, monkeypatch):
    monkeypatch.setattr(placetree, "CELL", 1, raising=False)
    points = spark.createDataFrame([(1, 1.5, 1.0)] * 3 + [(None, 1.5, 1.0), (2, None, 1.0), (3, 1.9, 1.0)], "id int, lon double, lat double")
    places = spark.range(1, 4).selectExpr("id AS place_id", "cast(id AS DOUBLE) AS lon", "1D AS lat", "concat('a', id) AS address")
    got = sorted(map(str, ((r["id"], r["address"]) for r in nearest_place(points, places, 100, small_places=0).collect())))
    assert got == ["(1, 'a1')"] * 3 + ["(2, None)", "(3, 'a2')", "(None, 'a1')"]
