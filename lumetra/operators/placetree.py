"""The places that the nearest one of a point is among, by a tree of cells on the globe.

Points and places are unit vectors. The cube around all places is halved along each axis as long as a cell holds more than
``CELL`` places (or one in ``CELLS`` of all), so that there are some thousand cells at any density and number of places. What
leaves the tasks is a cell's box alone. A point goes to the cell whose box is nearest and meets its places there; their
distance is one that the nearest place cannot exceed, and the point goes on only to the cells whose boxes are no farther.
So a point is shuffled once, and again if it lies close to the edge of its cell or outside.

In a task a cell's places and points are cut into small blocks, and blocks are compared by their boxes before their rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from lumetra.operators.skew import found, hot_keys, split_sides
from lumetra.session import stored

CELL = 1024
CELLS = 2048
GROUP = 65_536  # points of a cell that one task takes at once
DEEPEST = 18  # halvings: 50 m where places lie all over the globe
_STEP = 6  # levels counted at once
_PLACES, _POINTS = 16, 128  # of a block
_AXES = ("x", "y", "z")
_SLACK = 1e-11  # of the radius: more than rounding of distances to 9 places of a kilometre, and of the vectors


def unit(lon: str, lat: str) -> list[Column]:
    """A place on the globe as a vector of length one."""
    lon_, lat_ = F.radians(lon), F.radians(lat)
    return [(F.cos(lat_) * F.cos(lon_)).alias("x"), (F.cos(lat_) * F.sin(lon_)).alias("y"), F.sin(lat_).alias("z")]


def _units(t: pa.Table | pa.RecordBatch) -> np.ndarray:
    """As ``unit``, a row per point; NaN where a coordinate is missing."""
    lon, lat = (np.radians(np.asarray(pc.cast(t.column(c), pa.float64()).to_numpy(zero_copy_only=False))) for c in ("lon", "lat"))
    with np.errstate(invalid="ignore"):
        return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=1)


def _vectors(t: pa.Table | pa.RecordBatch) -> np.ndarray:
    return np.stack([t.column(a).to_numpy() for a in _AXES], axis=1)


class _Cube(NamedTuple):
    """The cube around all places."""

    low: np.ndarray
    edge: float

    def cells(self, xyz: np.ndarray, level: int) -> np.ndarray:
        """The number of each vector's cell; cells of different levels have different numbers."""
        at = np.floor((xyz - self.low) / self.edge * 2**level).astype(np.int64).clip(0, 2**level - 1)
        return (level << 3 * DEEPEST) + (at[:, 0] << 2 * DEEPEST) + (at[:, 1] << DEEPEST) + at[:, 2]

    def leaves(self, xyz: np.ndarray, crowded: np.ndarray) -> np.ndarray:
        """The first cell of each vector that is not crowded."""
        out, open_ = np.empty(len(xyz), np.int64), np.arange(len(xyz))
        for level in range(DEEPEST + 1):
            out[open_] = cells = self.cells(xyz[open_], level)
            open_ = open_[np.isin(cells, crowded)]
            if not len(open_):
                break
        return out


class _Boxes(NamedTuple):
    """Tight boxes around the rows of some cells or blocks."""

    low: np.ndarray
    high: np.ndarray

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least distance from any place of a box to any of the vectors between ``low`` and ``high``."""
        return np.sqrt((np.maximum(np.maximum(self.low - high, low - self.high), 0) ** 2).sum(axis=-1))

    def of(self, rows: np.ndarray) -> _Boxes:
        return _Boxes(self.low[rows], self.high[rows])


def _blocks(xyz: np.ndarray, rows: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The rows in blocks of neighbours."""
    if len(rows) <= size:
        if len(rows):
            yield rows
        return
    at = xyz[rows]
    half = len(rows) // 2
    order = np.argpartition(at[:, np.argmax(np.ptp(at, axis=0))], half)
    yield from _blocks(xyz, rows[order[:half]], size)
    yield from _blocks(xyz, rows[order[half:]], size)


def _count(cube: _Cube, levels: range, within: np.ndarray | None) -> Callable:
    def kernel(batches):
        for batch in batches:
            xyz = _vectors(batch)
            if within is not None:
                xyz = xyz[np.isin(cube.cells(xyz, levels[0] - 1), within)]
            for level in levels:
                cell, n = np.unique(cube.cells(xyz, level), return_counts=True)
                yield pa.RecordBatch.from_pydict({"cell": cell, "n": n.astype(np.int64)})

    return kernel


def _place(cube: _Cube, crowded: np.ndarray) -> Callable:
    def kernel(batches):
        for batch in batches:
            yield batch.append_column("cell", pa.array(cube.leaves(_vectors(batch), crowded)))

    return kernel


class Tree:
    """``places`` with their ``cell`` and the cells' boxes.

    The input has ``place_id``, ``lon``, ``lat``, ``address``; places at one spot count once, by the smallest id.
    """

    def __init__(self, places: DataFrame, chord: float):
        self.chord = chord * (1 + 1e-9) + _SLACK
        spots = (
            places.where("lon IS NOT NULL AND lat IS NOT NULL").groupBy("lon", "lat")
            .agg(F.min(F.struct("place_id", "address")).alias("_p"))
            .select(F.col("lon").alias("_lon"), F.col("lat").alias("_lat"), "_p", *unit("lon", "lat"))
        )
        spots = stored(spots.where(~F.isnan("x") & ~F.isnan("y") & ~F.isnan("z")), "spots")
        row = spots.agg(F.count(F.lit(1)), *[f(a) for f in (F.min, F.max) for a in _AXES]).first()
        n = row[0]
        low, high = (np.array(row[i:i + 3] if n else [0.0] * 3) for i in (1, 4))
        cube = _Cube(low, float(max(np.max(high - low), 1e-12)) * (1 + 1e-9))
        most = max(CELL, n // CELLS)
        crowded, within = [], None
        for first in range(0, DEEPEST, _STEP):
            levels = range(first, first + _STEP)
            counts = spots.mapInArrow(_count(cube, levels, within), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
            cells = np.sort(counts.where(F.col("n") > F.lit(most)).select("cell").toArrow()["cell"].to_numpy())
            crowded.append(cells)
            within = cells[cells >> 3 * DEEPEST == levels[-1]]
            if not len(within):
                break
        schema = StructType([*spots.schema.fields, StructField("cell", LongType())])
        self.places = stored(spots.mapInArrow(_place(cube, np.concatenate(crowded)), schema), "places")
        boxes = self.places.groupBy("cell").agg(*[f(a).alias(f"{n}_{a}") for n, f in (("low", F.min), ("high", F.max)) for a in _AXES])
        boxes = boxes.toArrow()
        self.cells = boxes["cell"].to_numpy()
        self.boxes = _Boxes(*(np.stack([boxes[f"{n}_{a}"].to_numpy() for a in _AXES], axis=1) for n in ("low", "high")))


def _first_cell(cells: np.ndarray, boxes: _Boxes, chord: float) -> Callable:
    """Each point's cell with the nearest box, or NULL if all are too far."""
    def kernel(batches):
        for batch in batches:
            xyz = _units(batch)
            cell = np.full(len(xyz), -1)
            for rows in _blocks(xyz, np.flatnonzero(np.isfinite(xyz).all(axis=1)), _POINTS):
                low, high = xyz[rows].min(axis=0), xyz[rows].max(axis=0)
                # no point of the block is farther from its nearest box
                far = np.sqrt((np.maximum(np.maximum(boxes.low - low, high - boxes.high), 0) ** 2).sum(axis=1)).min(initial=chord)
                near = np.flatnonzero(boxes.least(low, high) <= far + _SLACK)
                if len(near):
                    apart = boxes.of(near).least(xyz[rows, None], xyz[rows, None])
                    best = apart.argmin(axis=1)
                    cell[rows] = np.where(apart.min(axis=1) <= chord, cells[near[best]], -1)
            yield batch.append_column("cell", pa.array(cell, mask=cell == -1))

    return kernel


def _lists(rows: list[np.ndarray], values: list[np.ndarray], n: int) -> tuple[pa.Array, np.ndarray]:
    """Offsets of the lists of ``n`` rows and their values, of pairs in any order of rows."""
    rows, values = (np.concatenate([np.empty(0, np.int64), *x]) for x in (rows, values))
    return pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]), pa.int32()), values[np.argsort(rows, kind="stable")]


def _nearest(names: list[str], chord: float, cells: np.ndarray | None = None, boxes: _Boxes | None = None) -> Callable:
    """The places of a cell that are nearest to each of its points and no farther than ``upto``, if given. With ``boxes`` also the
    other cells that may hold one as near, and the distance of the nearest so far."""
    def kernel(points: pa.Table, places: pa.Table) -> pa.Table:
        n, xyz, all_ = points.num_rows, _units(points), _vectors(places)
        parts = list(_blocks(all_, np.arange(len(all_)), _PLACES))
        by_part = np.concatenate(parts)
        starts = np.cumsum([0, *(len(p) for p in parts)])
        all_ = all_[by_part]
        part = _Boxes(np.minimum.reduceat(all_, starts[:-1]), np.maximum.reduceat(all_, starts[:-1]))
        upto = points["upto"].to_numpy().copy() if boxes is None else np.full(n, chord)
        met, also = ([], []), ([], [])
        for rows in _blocks(xyz, np.arange(n), _POINTS):
            p = xyz[rows]
            low, high = p.min(axis=0), p.max(axis=0)
            far = np.sqrt((np.maximum(part.high - low, high - part.low) ** 2).sum(axis=1)).min()
            near = np.flatnonzero(part.least(low, high) <= min(far, upto[rows].max()) + _SLACK)
            if len(near):
                at = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in near])
                apart = np.sqrt(sum((p[:, None, a] - all_[None, at, a]) ** 2 for a in range(3)))
                upto[rows] = np.minimum(upto[rows], apart.min(axis=1))
                i, j = np.nonzero(apart <= upto[rows, None] + _SLACK)
                met[0].append(rows[i])
                met[1].append(by_part[at[j]])
            if boxes is not None:
                near = np.flatnonzero((boxes.least(low, high) <= upto[rows].max() + _SLACK) & (cells != points["cell"][0].as_py()))
                i, j = np.nonzero(boxes.of(near).least(p[:, None], p[:, None]) <= upto[rows, None] + _SLACK)
                also[0].append(rows[i])
                also[1].append(cells[near[j]])
        offsets, values = _lists(*met, n)
        places = places.select(["_lon", "_lat", "_p"]).take(pa.array(values))
        struct = pa.StructArray.from_arrays([places.column(c).combine_chunks() for c in range(3)], fields=list(places.schema))
        columns = [points.column(c) for c in ("id", "lon", "lat")] + [pa.ListArray.from_arrays(offsets, struct)]
        if boxes is not None:
            offsets, values = _lists(*also, n)
            columns += [pa.array(upto), pa.ListArray.from_arrays(offsets, pa.array(values, pa.int64()))]
        return pa.Table.from_arrays(columns, names=names)

    return kernel


def search(points: DataFrame, tree: Tree, best: Callable[[str], str], hot_rows: int, hot_pairs: int) -> DataFrame:
    """``id``, ``lon``, ``lat`` of each point and ``best``: the least struct of what ``best`` makes of the places near it, as SQL
    text of an array of ``(_lon, _lat, _p)``. Repeated points are kept. Cells with many points are split by point."""
    point = ["id", "lon", "lat"]
    points = points.select(*point)
    cells, boxes, chord = tree.cells, tree.boxes, tree.chord
    place = ArrayType(StructType([f for f in tree.places.schema.fields if f.name in ("_lon", "_lat", "_p")]))
    again = StructType([*points.schema.fields, StructField("near", place)])
    once = StructType([*again.fields, StructField("upto", DoubleType()), StructField("also", ArrayType(LongType()))])

    def met(asked: DataFrame, schema: StructType, *others) -> DataFrame:
        hot = found(hot_keys(asked, tree.places, ["cell"], min(hot_rows, GROUP), hot_pairs))
        one, other = split_sides(asked, tree.places, ["cell"], point, hot)
        keys = [c for c in one.columns if c in other.columns]
        kernel = _nearest(schema.fieldNames(), chord, *others)
        near = one.groupBy(*keys).cogroup(other.groupBy(*keys)).applyInArrow(kernel, schema)
        return near.select(*point, F.expr(best("near")).alias("best"), *schema.fieldNames()[len(again):])

    placed = StructType([*points.schema.fields, StructField("cell", LongType())])
    asked = stored(points.mapInArrow(_first_cell(cells, boxes, chord), placed), "asked")
    first = stored(met(asked.where("cell IS NOT NULL"), once, cells, boxes), "first")
    open_ = first.where(F.size("also") > 0)
    second = met(open_.select(*point, "upto", F.explode("also").alias("cell")), again)
    both = open_.select(*point, "best", F.lit(1).alias("_n")).unionByName(second.select(*point, "best", F.lit(0).alias("_n")))
    # a point met its first cell once, as often as it is repeated
    both = both.groupBy(*point).agg(F.min("best").alias("best"), F.sum("_n").alias("_n"))
    repeated = both.select(*point, "best", F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_n")).drop("_n")
    far = asked.where("cell IS NULL").select(*point, F.lit(None).cast(first.schema["best"].dataType).alias("best"))
    return first.where(F.size("also") == 0).select(*point, "best").unionByName(repeated).unionByName(far)
