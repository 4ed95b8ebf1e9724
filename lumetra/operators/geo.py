"""Nearest reference place of a point."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetra.operators import placetree
from lumetra.operators.skew import HOT_PAIRS, HOT_ROWS

EARTH_KM = 6371.0088
_MARGIN = 1 + 1e-9
SMALL_PLACES = 50_000
CROWDED = 64


def haversine_km(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """SQL text of the great-circle distance."""
    return (
        f"2 * {EARTH_KM} * asin(sqrt(least(1D, pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1}))"
        f" * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def nearest_place(
    points: DataFrame, places: DataFrame, max_km: float, small_places: int = SMALL_PLACES,
    hot_rows: int = HOT_ROWS, hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """``(id, lon, lat, address)``: the nearest place within ``max_km``, or NULL; ties by place id.

    The globe is cut into bands of latitude ``max_km`` high, and each band into cells as wide as
    ``max_km`` spans at the band's highest latitude (one cell where a circle takes in a pole).
    A place is entered into the three cells around it of its own band and of the two next to it,
    so that a point meets in its own cell all places that can be near enough. Places at one spot
    count once, by the smallest id.

    Up to ``small_places`` places (nine entries each) of which no cell meets more than ``CROWDED``
    are broadcast as one list per cell, and the points are not shuffled at all. Otherwise the
    points are sent to cells of some thousand places each, at any density (``placetree``): to the
    one with the nearest box, and to those that may hold a place nearer than the nearest there.
    Points without coordinates have no place; repeated points are kept.
    """
    reach = max_km / EARTH_KM * _MARGIN
    band = math.degrees(reach)

    def n_cells(y: str) -> str:
        top = f"radians(greatest(abs({y}), abs({y} + 1)) * {band!r}D)"
        inside = f"{top} + {reach!r}D < {math.pi / 2!r}D"
        width = f"degrees(asin(least(1D, {math.sin(reach)!r}D / cos({top}))))"
        return f"CASE WHEN {inside} THEN greatest(1L, floor(360 / ({width} * {_MARGIN!r}D))) ELSE 1L END"

    def cell(n: str) -> str:
        return f"floor((lon + 180) / 360 * {n})"

    spots = places.groupBy("lon", "lat").agg(F.min(F.struct("place_id", "address")).alias("_p"))
    entered = (
        spots.selectExpr("lon", "lat", "_p", f"explode(transform(array(-1, 0, 1), d -> floor(lat / {band!r}D) + d)) AS _y")
        .selectExpr("*", f"{n_cells('_y')} AS _n")
        .selectExpr(
            "_y", f"explode(array_distinct(transform(array(-1, 0, 1), d -> pmod({cell('_n')} + d, _n)))) AS _x",
            "lon AS _lon", "lat AS _lat", "_p",
        )
    )
    placed = (
        points.selectExpr("id", "lon", "lat", f"floor(lat / {band!r}D) AS _y")
        .selectExpr("*", f"{n_cells('_y')} AS _n")
        .selectExpr("id", "lon", "lat", "_y", f"pmod({cell('_n')}, _n) AS _x")
    )
    def near(lon: str, lat: str, place: str) -> str:
        km = f"round({haversine_km('lon', 'lat', lon, lat)}, 9)"
        found_place = f"struct({km} AS km, {place}.place_id AS place_id, {place}.address AS address)"
        return f"CASE WHEN {km} <= {float(max_km)!r}D THEN {found_place} END"

    def best(near_places: str) -> str:
        return f"array_min(transform({near_places}, e -> {near('e._lon', 'e._lat', 'e._p')}))"

    if places.count() <= small_places:
        cells = entered.groupBy("_x", "_y").agg(F.collect_list(F.struct("_lon", "_lat", "_p")).alias("_near"))
        if (cells.agg(F.max(F.size("_near"))).first()[0] or 0) <= CROWDED:
            found_places = placed.join(F.broadcast(cells), ["_x", "_y"], "left")
            return found_places.selectExpr("id", "lon", "lat", f"{best('_near')}.address AS address")

    tree = placetree.Tree(places, 2 * math.sin(min(reach, math.pi) / 2))
    found_places = placetree.search(points, tree, best, hot_rows, hot_pairs)
    return found_places.select("id", "lon", "lat", F.col("best.address").alias("address"))
