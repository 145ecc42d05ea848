"""Grids, boxes, polygons and raster cells.

Polygons are tables (code, ring, lon, lat, next_lon, next_lat): one row an edge. Points meet polygons through integer
cells, an equi-join, before any exact test, so no point is compared with every polygon.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import fresh, scratch
from ..functions.standardize import inside_box
from .counting import counts_around
from .covering import inside
from .ranking import join_on, quantiles
from .screening import cell_index

METRES = 111320.0


def bbox_filter(df: DataFrame, box: Sequence[float], lon: str = "lon", lat: str = "lat") -> DataFrame:
    return df.filter(inside_box(F.col(lon), F.col(lat), box))


def _spans(west: Column, east: Column) -> Column:
    """A longitude interval as one or two that don't wrap."""
    one = F.array(F.struct(west.alias("w"), east.alias("e")))
    two = F.array(F.struct(west.alias("w"), F.lit(180.0).alias("e")), F.struct(F.lit(-180.0).alias("w"), east.alias("e")))
    return F.when(west <= east, one).otherwise(two)


def bbox_intersects(a: DataFrame, b: DataFrame, degrees: float = 10.0) -> DataFrame:
    """(a_id, b_id) of boxes (id, west, south, east, north) that overlap, touching included, across the antimeridian.

    Boxes are dealt to the grid cells they cover and joined by cell.
    """

    def dealt(df: DataFrame, p: str) -> DataFrame:
        df = df.select(F.col("id").alias(f"{p}_id"), F.col("south").alias(f"{p}s"), F.col("north").alias(f"{p}n"), F.explode(_spans(F.col("west"), F.col("east"))).alias("x"))
        df = df.select("*", F.col("x.w").alias(f"{p}w"), F.col("x.e").alias(f"{p}e")).drop("x")
        x0, y0 = cell_index(F.col(f"{p}w"), F.col(f"{p}s"), degrees)
        x1, y1 = cell_index(F.col(f"{p}e"), F.col(f"{p}n"), degrees)
        return df.withColumn("cx", F.explode(F.sequence(x0, x1))).withColumn("cy", F.explode(F.sequence(y0, y1)))

    met = dealt(a, "a").join(dealt(b, "b"), ["cx", "cy"])
    hit = met.filter("aw <= be and bw <= ae and as <= bn and bs <= an")
    return hit.select("a_id", "b_id").distinct()


def edges(polygons: DataFrame) -> DataFrame:
    """(code, ring, i, lon, lat, next_lon, next_lat) of polygons (code, rings array<array<array<double>>>), rings closed."""
    rings = polygons.select("code", F.posexplode("rings").alias("ring", "points"))
    at = rings.select("code", "ring", "points", F.posexplode("points").alias("i", "p"))
    following = F.coalesce(F.get("points", F.col("i") + 1), F.get("points", F.lit(0)))
    return at.select("code", "ring", "i", F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat"), following[0].alias("next_lon"), following[1].alias("next_lat"))


def point_in_polygon(points: DataFrame, polygons: DataFrame, degrees: float = 1.0, key: str = "record_id") -> DataFrame:
    """(key, code) of the points (key, lon, lat) inside each polygon, by coverings of grid cells (``covering``): a point
    meets only the edges of its own cell, and none in a cell that lies inside."""
    return inside(points, edges(polygons), [key], degrees)


def region_filter(obs: DataFrame, box: Sequence[float], polygons: DataFrame | None = None, key: str = "record_id") -> DataFrame:
    """Rows in the box and, if polygons are given, in any of them."""
    inside = bbox_filter(obs, box)
    return inside if polygons is None else inside.join(point_in_polygon(inside, polygons, key=key).select(key).distinct(), key, "left_semi")


def point_to_country(points: DataFrame, polygons: DataFrame, key: str = "record_id") -> DataFrame:
    """Add country (the least code that holds the point), macroregion, else open ocean; no point: null. Columns of these
    names are replaced."""
    points = points.drop("country", "macroregion")
    held = point_in_polygon(points, polygons.select("code", "rings"), key=key).groupBy(key).agg(F.min("code").alias("country"))
    named = held.join(polygons.select(F.col("code").alias("country"), "macroregion"), "country")
    out = points.join(named, key, "left")
    ocean = F.col("lon").isNotNull() & F.col("country").isNull()
    return out.withColumns({"country": F.when(ocean, "ocean").otherwise(F.col("country")), "macroregion": F.when(ocean, "open ocean").otherwise(F.col("macroregion"))})


def segment_metres(lon: Column, lat: Column, e: Column) -> Column:
    """Distance to an edge on a local flat map."""
    kx = F.cos(F.radians(lat)) * METRES
    ax, ay = (e["lon"] - lon) * kx, (e["lat"] - lat) * METRES
    bx, by = (e["next_lon"] - lon) * kx, (e["next_lat"] - lat) * METRES
    dx, dy = bx - ax, by - ay
    size = dx * dx + dy * dy
    t = F.when(size > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), -(ax * dx + ay * dy) / size))).otherwise(0.0)
    return F.sqrt(F.pow(ax + t * dx, 2) + F.pow(ay + t * dy, 2))


def domain_scope_filter(obs: DataFrame, polygons: DataFrame, km: float, key: str = "record_id") -> DataFrame:
    """Land and inland water inside a polygon; marine rows outside all, within ``km`` of an edge. Adds how: inside or near."""
    edge_table = edges(polygons)
    inside = point_in_polygon(obs.filter("domain <> 'marine'"), polygons, key=key).select(key).distinct().withColumn("how", F.lit("inside"))
    reach = km * 1000 / METRES
    cells = 5.0
    wide = edge_table.withColumn("r", F.lit(reach) / F.greatest(F.lit(0.05), F.cos(F.radians(F.least(F.lit(89.0), F.greatest(F.abs("lat"), F.abs("next_lat")) + reach)))))
    x0, y0 = cell_index(F.least("lon", "next_lon") - F.col("r"), F.least("lat", "next_lat") - reach, cells)
    x1, y1 = cell_index(F.greatest("lon", "next_lon") + F.col("r"), F.greatest("lat", "next_lat") + reach, cells)
    near_cells = wide.select(F.struct("lon", "lat", "next_lon", "next_lat").alias("e"), F.explode(F.sequence(x0, x1)).alias("cx"), F.sequence(y0, y1).alias("ys")).select("e", "cx", F.explode("ys").alias("cy"))
    px, py = cell_index(F.col("lon"), F.col("lat"), cells)
    sea = obs.filter("domain = 'marine' and lon is not null").select(key, "lon", "lat", px.alias("cx"), py.alias("cy"))
    gone = point_in_polygon(sea, polygons, key=key).select(key)
    near = sea.join(near_cells, ["cx", "cy"]).groupBy(key).agg(F.min(segment_metres(F.col("lon"), F.col("lat"), F.col("e"))).alias("m")).filter(F.col("m") <= km * 1000)
    near = near.join(gone, key, "left_anti").select(key, F.lit("near").alias("how"))
    return obs.join(inside.unionByName(near), key)


@scratch("_row", "_col")
def raster_cell_join(obs: DataFrame, raster: DataFrame, degrees: float = 0.5) -> DataFrame:
    """Add class_id, edge_metres and raster_status by the cell (row, col) of a raster table.

    Marine rows are not applicable; a row nearer to its cell's edge than its coordinate uncertainty is uncertain.
    """
    x, y = cell_index(F.col("lon"), F.col("lat"), degrees)
    placed = obs.withColumns({"_col": x, "_row": y})
    joined = placed.join(raster.select(F.col("row").alias("_row"), F.col("col").alias("_col"), "class_id"), ["_row", "_col"], "left")
    east = (F.col("lon") + 180) - F.col("_col") * degrees
    north = (F.col("lat") + 90) - F.col("_row") * degrees
    kx = F.cos(F.radians("lat")) * METRES
    edge = F.least(east * kx, (degrees - east) * kx, north * METRES, (degrees - north) * METRES)
    out = joined.withColumn("edge_metres", edge)
    status = (
        F.when(F.col("lon").isNull(), "no_coordinate").when(F.col("domain") == "marine", "not_applicable").when(F.col("class_id").isNull(), "no_coverage")
        .when(F.col("edge_metres") <= F.col("uncertainty_m"), "boundary_uncertain").otherwise("matched")
    )
    return out.withColumn("raster_status", status).drop("_row", "_col")


def concentration_grid(obs: DataFrame, element: str, degrees: float, layer: Sequence[str]) -> DataFrame:
    """Cells x comparability layer of one element: records, samples, quantified, censored, unquantified, quartiles."""
    x, y = cell_index(F.col("lon"), F.col("lat"), degrees)
    shown = F.when(F.col("qualifier") == "reported", F.col("value"))
    rows = obs.filter((F.col("element") == element) & F.col("lon").isNotNull()).select(*layer, "sample_id", "qualifier", "value", x.alias("cell_x"), y.alias("cell_y"), shown.alias("shown"))
    keys = ["cell_x", "cell_y", *layer]
    counts = rows.groupBy(*keys).agg(
        F.count("*").alias("records"), F.count_distinct("sample_id").alias("samples"), F.count("shown").alias("quantified"), F.count_if(F.col("qualifier") != "reported").alias("censored"),
        F.count_if((F.col("qualifier") == "reported") & F.col("value").isNull()).alias("unquantified"),
    )
    return join_on(counts, quantiles(rows, keys, "shown", {"median": 0.5, "q25": 0.25, "q75": 0.75}), keys, "left")


def target_grid(spark, box: Sequence[float], degrees: float, polygons: DataFrame, zones: tuple[int, int] = (2, 3), bands: int = 4) -> DataFrame:
    """Every cell of a box (that doesn't wrap) with its country by centre, zone (macroregion, or open ocean, and row x column
    sector) and longitude band."""
    west, south, east, north = box
    nx, ny = int(round((east - west) / degrees)), int(round((north - south) / degrees))
    cells = spark.range(nx * ny).select((F.col("id") % nx).cast("int").alias("i"), F.floor(F.col("id") / nx).cast("int").alias("j"))
    cells = cells.withColumns({"lon": F.lit(west) + (F.col("i") + 0.5) * degrees, "lat": F.lit(south) + (F.col("j") + 0.5) * degrees, "record_id": F.concat_ws(":", "j", "i")})
    placed = point_to_country(cells, polygons)
    zone = F.concat(F.col("macroregion"), F.lit(":"), F.floor(F.col("j") * zones[0] / ny).cast("int"), F.lit("-"), F.floor(F.col("i") * zones[1] / nx).cast("int"))
    rank = F.row_number().over(Window.partitionBy("country").orderBy("lon", "lat")) - 1
    size = F.count("*").over(Window.partitionBy("country"))
    return placed.select(F.col("record_id").alias("cell"), "lon", "lat", "country", "macroregion", zone.alias("zone"), F.floor(rank * bands / size).cast("int").alias("band"))


def filled_grid(grid: DataFrame, obs: DataFrame, box: Sequence[float], degrees: float) -> DataFrame:
    """``grid``, a target grid of the box, with the records and samples of ``obs`` in each cell."""
    west, south, east, north = box
    i, j = F.floor((F.col("lon") - west) / degrees).cast("int"), F.floor((F.col("lat") - south) / degrees).cast("int")
    inside = obs.filter((F.col("lon") >= west) & (F.col("lon") < east) & (F.col("lat") >= south) & (F.col("lat") < north))
    held = inside.groupBy(F.concat_ws(":", j, i).alias("cell")).agg(F.count("*").alias("records"), F.count_distinct("sample_id").alias("samples"))
    return grid.join(held, "cell", "left").withColumns({"records": F.coalesce("records", F.lit(0)), "samples": F.coalesce("samples", F.lit(0))})


def neighbor_count(flagged: DataFrame, degrees: float = 1.0) -> DataFrame:
    """``flagged`` with ``neighbours`` and ``peers``: high candidates of the same element and medium within ``degrees`` both
    ways, those at the row's own place left out, and all of them anywhere.

    Rows with a place count as peers if their direction is high; the row itself may be of any. Without a place
    ``neighbours`` is null. Longitudes aren't wrapped. Rows of a place are one place with a weight, and places
    are counted by ``counts_around``, which makes no pairs.
    """
    kind = ["element", "medium"]
    spot = [*kind, "lon", "lat"]
    high, around = fresh(flagged, "high", "around")
    is_high = F.coalesce(F.col("direction") == "high", F.lit(False))
    places = flagged.filter("lon is not null and lat is not null").groupBy(*spot).agg(F.count_if(is_high).alias(high))
    sums = counts_around(places, kind, "lon", "lat", high, degrees, around)
    near = join_on(sums, places, spot).select(*spot, (F.col(around) - F.col(high)).alias("neighbours"))
    peers = places.groupBy(*kind).agg(F.sum(high).alias("peers"))
    rows = flagged.drop("neighbours", "peers")
    out = join_on(join_on(rows, near, spot, "left"), peers, kind, "left")
    return out.withColumn("peers", F.coalesce("peers", F.lit(0)))
