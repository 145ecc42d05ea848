"""Measurements laid out by place, so that a box reads few files.

Places are cells of a grid numbered along a Morton curve (``curve``): cells that are close have close numbers, and
the first bits of a number name the coarser cell, the tile, around it. A table is written in folders by its keys
(medium and element, say) and tile, sorted along the curve within. A box becomes a few ranges of tiles: Spark then
lists only their folders, and within files the extremes of row groups leave out more.

Rows without a place have a folder of their own, which no box reads. A key may be null; its text names the folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.standardize import inside_box

#: Bits of a cell number along each axis: cells of 0.0055 x 0.0027 degrees.
BITS = 16
NOWHERE = -1
#: Wider than what rounding moves a place or the edge of a box, in degrees.
SLACK = 1e-9


def _spread(v: Column) -> Column:
    """The bits of a number below 2^16 at even places."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return v


def curve(lon: Column, lat: Column) -> Column:
    """The number of a place's cell along the curve, of 32 bits; places beyond the edges count as on them."""
    side = 1 << BITS
    at = lambda v, span: F.greatest(F.lit(0), F.least(F.lit(side - 1), F.floor((v + span / 2) / span * side))).cast("bigint")
    return _spread(at(lon, 360.0)).bitwiseOR(F.shiftleft(_spread(at(lat, 180.0)), 1))


def tile_ranges(box: Sequence[float], level: int) -> list[tuple[int, int]]:
    """Ranges of tiles, both ends included, that hold every place of a box (west, south, east, north); one whose west is
    larger than its east crosses the antimeridian. At most as many as tiles along the box's edges."""
    west, south, east, north = box
    if west > east:
        return _joined(tile_ranges((west, south, 180.0, north), level) + tile_ranges((-180.0, south, east, north), level))
    west, south, east, north = west - SLACK, south - SLACK, east + SLACK, north + SLACK
    found = []

    def walk(x: int, y: int, depth: int, z: int) -> None:
        w, h = 360.0 / (1 << depth), 180.0 / (1 << depth)
        left, low = x * w - 180.0, y * h - 90.0
        if left > east or left + w < west or low > north or low + h < south:
            return
        within = left >= west and left + w <= east and low >= south and low + h <= north
        if within or depth == level:
            below = 2 * (level - depth)
            found.append((z << below, ((z + 1) << below) - 1))
            return
        for k in range(4):
            walk(2 * x + (k & 1), 2 * y + (k >> 1), depth + 1, 4 * z + k)

    walk(0, 0, 0, 0)
    return _joined(found)


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _folder(value: Column) -> Column:
    """A key as a folder's name that no reader takes for a number."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def write_by_place(df: DataFrame, path: str, keys: Sequence[str] = ("medium", "element"), lon: str = "lon", lat: str = "lat", level: int = 4, rows_a_file: int = 5_000_000) -> None:
    """Write ``df`` to ``path``, laid out by keys and place with 4^level tiles.

    Tasks take ranges of (keys, curve, a hash of the row): the last splits a place where a third of all rows lies.
    What tells a reader the layout is written last.
    """
    folders = [f"key_{i}" for i in range(len(keys))]
    if set(c.lower() for c in df.columns) & {*folders, "tile"}:
        raise ValueError("columns key_0, ... and tile name the folders of the layout")
    z = F.when(F.col(f"`{lon}`").isNotNull() & F.col(f"`{lat}`").isNotNull(), curve(F.col(f"`{lon}`"), F.col(f"`{lat}`")))
    tile = F.coalesce(F.shiftright(z, 2 * (BITS - level)), F.lit(NOWHERE).cast("bigint"))
    rows = df.withColumns({**{f: _folder(F.col(f"`{k}`")) for f, k in zip(folders, keys)}, "tile": tile})
    order = [*folders, F.coalesce(z, F.lit(NOWHERE)), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", rows_a_file).partitionBy(*folders, "tile").parquet(path)
    shape = (list(keys), lon, lat, level)
    df.sparkSession.createDataFrame([shape], "keys array<string>, lon string, lat string, level int").coalesce(1).write.parquet(f"{path}/_shape")


def _of_tiles(spark: SparkSession, path: str, box: Sequence[float] | None, values: dict[str, Sequence]) -> tuple[DataFrame, str, str]:
    """The rows in the folders that a box and values of keys name, and the columns of the place."""
    shape = spark.read.parquet(f"{path}/_shape").first()
    rows = spark.read.parquet(path)
    for k, wanted in values.items():
        names = ["null" if v is None else f"={v}" for v in wanted]
        rows = rows.filter(F.col(f"key_{shape['keys'].index(k)}").isin(*names))
    if box is not None:
        ranges = [F.col("tile").between(low, high) for low, high in tile_ranges(box, shape.level)]
        rows = rows.filter(reduce(lambda a, b: a | b, ranges, F.lit(False)))
    return rows.drop("tile", *[f"key_{i}" for i in range(len(shape["keys"]))]), shape.lon, shape.lat


def read_by_place(spark: SparkSession, path: str, box: Sequence[float] | None = None, **values: Sequence) -> DataFrame:
    """The rows of a layout inside ``box`` (edges included; None: everywhere and nowhere) whose keys have one of ``values``:
    ``read_by_place(spark, path, box, medium=["soil"], element=["As", "Pb"])``."""
    rows, lon, lat = _of_tiles(spark, path, box, values)
    return rows if box is None else rows.filter(inside_box(F.col(f"`{lon}`"), F.col(f"`{lat}`"), box))
