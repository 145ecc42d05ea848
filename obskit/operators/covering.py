"""Polygons as coverings of grid cells, each of which knows only the edges in it.

A polygon's edges are dealt to the cells that they pass. The corner of a cell is inside if an odd number of edges crosses
the line east of it; crossings are counted by cell and added up along a row, so no corner meets an edge either. A cell
without edges is inside or outside as a whole. In the others a point is led to the corner inside the cell, due east
to the cell's border and along this down to the corner, and every edge crossed on the way changes sides. Cells with
many edges are cut into finer ones, whose corners are decided by the same walk, until few edges are left in each.

Grid lines are shifted by an odd fraction, so that no vertex of practical data lies on one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import written

#: What an edge is: the ends, and its place in the polygon, so that two edges between the same points stay two.
EDGE = ("ring", "i", "lon", "lat", "next_lon", "next_lat")
#: Where grid lines start.
WEST, SOUTH = -180.0 - 0.00913742, -90.0 - 0.00713751


def cell_of(lon: Column, lat: Column, degrees: float) -> tuple[Column, Column]:
    return F.floor((lon - WEST) / degrees).cast("int"), F.floor((lat - SOUTH) / degrees).cast("int")


def _lon_at(e: Column, lat: Column) -> Column:
    """Where the line through an edge that isn't level meets a latitude."""
    return e["lon"] + (lat - e["lat"]) * (e["next_lon"] - e["lon"]) / F.when(e["next_lat"] != e["lat"], e["next_lat"] - e["lat"]).otherwise(1.0)


def _lat_at(e: Column, lon: Column) -> Column:
    return e["lat"] + (lon - e["lon"]) * (e["next_lat"] - e["lat"]) / F.when(e["next_lon"] != e["lon"], e["next_lon"] - e["lon"]).otherwise(1.0)


def walk_is_odd(lon: Column, lat: Column, east: Column, south: Column, edges: Column) -> Column:
    """Do the edges cross the walk from a point due east to ``east`` and then down to ``south`` an odd number of times?"""

    def crossed(e: Column) -> Column:
        level = ((e["lat"] > lat) != (e["next_lat"] > lat)) & (_lon_at(e, lat) > lon) & (_lon_at(e, lat) <= east)
        upright = ((e["lon"] > east) != (e["next_lon"] > east)) & (_lat_at(e, east) <= lat) & (_lat_at(e, east) > south)
        return level.cast("int") + upright.cast("int")

    return F.aggregate(F.transform(edges, crossed), F.lit(0), lambda a, b: a + b) % 2 == 1


def on_an_edge(lon: Column, lat: Column, edges: Column) -> Column:
    def touching(e: Column) -> Column:
        cross = (lon - e["lon"]) * (e["next_lat"] - e["lat"]) - (lat - e["lat"]) * (e["next_lon"] - e["lon"])
        return (F.abs(cross) < 1e-12) & lon.between(F.least(e["lon"], e["next_lon"]), F.greatest(e["lon"], e["next_lon"])) & lat.between(F.least(e["lat"], e["next_lat"]), F.greatest(e["lat"], e["next_lat"]))

    return F.exists(edges, touching)


def edges_by_cell(edge_table: DataFrame, degrees: float) -> DataFrame:
    """(code, cx, cy, e): each edge once for every cell that it passes, row by row."""
    e = F.col("e")
    room = 1e-9  # a point beside a grid line may touch an edge beyond it
    _, y0 = cell_of(F.lit(0.0), F.least(e["lat"], e["next_lat"]) - room, degrees)
    _, y1 = cell_of(F.lit(0.0), F.greatest(e["lat"], e["next_lat"]) + room, degrees)
    rows = edge_table.select("code", F.struct(*EDGE).alias("e")).withColumn("cy", F.explode(F.sequence(y0, y1)))
    bottom = SOUTH + F.col("cy") * degrees - room
    clip = lambda lat: F.least(F.greatest(lat, bottom), bottom + degrees + 2 * room)
    at = [F.when(e["next_lat"] == e["lat"], x).otherwise(_lon_at(e, clip(y))) for x, y in ((e["lon"], e["lat"]), (e["next_lon"], e["next_lat"]))]
    x0, _ = cell_of(F.least(*at) - room, F.lit(0.0), degrees)
    x1, _ = cell_of(F.greatest(*at) + room, F.lit(0.0), degrees)
    return rows.withColumn("cx", F.explode(F.sequence(x0, x1))).select("code", "cx", "cy", "e")


def corners_inside(edge_table: DataFrame, degrees: float) -> DataFrame:
    """(code, cx, cy, odd): for the cells of each polygon's box, whether their south-east corner is inside it."""
    box = edge_table.groupBy("code").agg(F.min("lon").alias("w"), F.max("lon").alias("e"), F.min("lat").alias("s"), F.max("lat").alias("n"))
    (x0, y0), (x1, y1) = cell_of(F.col("w"), F.col("s"), degrees), cell_of(F.col("e"), F.col("n"), degrees)
    cells = box.select("code", x0.alias("x0"), x1.alias("x1"), F.explode(F.sequence(y0, y1)).alias("cy")).select("code", "cy", F.explode(F.sequence("x0", "x1")).alias("cx"))
    e = F.struct(*EDGE)
    _, low = cell_of(F.lit(0.0), F.least("lat", "next_lat"), degrees)
    _, high = cell_of(F.lit(0.0), F.greatest("lat", "next_lat"), degrees)
    lines = edge_table.select("code", e.alias("e"), F.explode(F.sequence(low, high)).alias("cy"))
    line = SOUTH + F.col("cy") * degrees
    met = lines.filter((F.col("e.lat") > line) != (F.col("e.next_lat") > line))
    x, _ = cell_of(_lon_at(F.col("e"), line), F.lit(0.0), degrees)
    counts = met.groupBy("code", "cy", x.alias("cx")).agg(F.count("*").alias("k"))
    east = Window.partitionBy("code", "cy").orderBy(F.desc("cx")).rowsBetween(Window.unboundedPreceding, -1)
    summed = cells.join(counts, ["code", "cy", "cx"], "left").withColumn("k", F.coalesce(F.sum("k").over(east), F.lit(0)))
    return summed.select("code", "cx", "cy", (F.col("k") % 2 == 1).alias("odd"))


def covering(edge_table: DataFrame, degrees: float = 1.0, crowded: int = 64, parts: int = 8, depth: int = 3) -> tuple[DataFrame, list[float]]:
    """(code, level, cx, cy, odd, edges) and the cell size of each level; ``edges`` is null where the whole cell is inside.

    Cells with over ``crowded`` edges are replaced by ``parts`` x ``parts`` finer ones, up to ``depth`` times. The table is
    written once, level by level.
    """
    held = edges_by_cell(edge_table, degrees).groupBy("code", "cx", "cy").agg(F.collect_list("e").alias("edges"))
    cells = corners_inside(edge_table, degrees).join(held, ["code", "cx", "cy"], "full").withColumn("odd", F.coalesce("odd", F.lit(False)))
    cells = written(cells.filter("odd or edges is not null"))
    sizes, levels = [degrees], []
    while True:
        many = F.coalesce(F.size("edges") > crowded, F.lit(False))
        last = len(sizes) > depth
        levels.append((cells if last else cells.filter(~many)).withColumn("level", F.lit(len(sizes) - 1)))
        if last or not cells.filter(many).limit(1).count():
            break
        big, small = sizes[-1], sizes[-1] / parts
        parent = cells.filter(many).select("code", F.col("cx").alias("px"), F.col("cy").alias("py"), "odd", "edges")
        step = F.sequence(F.lit(0), F.lit(parts - 1))
        fine = parent.withColumn("cx", F.explode(F.transform(step, lambda i: F.col("px") * parts + i))).withColumn("cy", F.explode(F.transform(step, lambda i: F.col("py") * parts + i)))
        corner = (WEST + (F.col("cx") + 1) * small, SOUTH + F.col("cy") * small)
        odd = F.col("odd") != walk_is_odd(*corner, WEST + (F.col("px") + 1) * big, SOUTH + F.col("py") * big, F.col("edges"))
        fine = fine.select("code", "cx", "cy", odd.alias("odd"))
        inner = parent.select("code", F.explode("edges").alias("e")).select("code", "e.*").distinct()
        dealt = edges_by_cell(inner, small).groupBy("code", "cx", "cy").agg(F.collect_list("e").alias("edges"))
        cells = written(fine.join(dealt, ["code", "cx", "cy"], "left").filter("odd or edges is not null"))
        sizes.append(small)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out, sizes


def inside(points: DataFrame, edge_table: DataFrame, keep: Sequence[str], degrees: float = 1.0, crowded: int = 64) -> DataFrame:
    """``keep`` and code of the ``points`` (keep, lon, lat) in each polygon, one on its boundary included."""
    cells, sizes = covering(edge_table, degrees, crowded)
    lon, lat = F.col("lon"), F.col("lat")
    at = [F.struct(F.lit(i).alias("level"), *[c.alias(n) for c, n in zip(cell_of(lon, lat, d), ("cx", "cy"))]) for i, d in enumerate(sizes)]
    placed = points.filter("lon is not null and lat is not null").select(*keep, "lon", "lat", F.explode(F.array(*at)).alias("at")).select(*keep, "lon", "lat", "at.*")
    size = F.element_at(F.array(*[F.lit(d) for d in sizes]), F.col("level") + 1)
    walk = walk_is_odd(lon, lat, WEST + (F.col("cx") + 1) * size, SOUTH + F.col("cy") * size, F.col("edges"))
    holds = F.when(F.col("edges").isNull(), F.col("odd")).otherwise((F.col("odd") != walk) | on_an_edge(lon, lat, F.col("edges")))
    return placed.join(cells, ["level", "cx", "cy"]).filter(holds).select(*keep, "code")
