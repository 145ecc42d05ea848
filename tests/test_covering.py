"""Coverings against the even-odd test over all edges: holes, shared sides, huge rings, boundaries, crowded cells."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from obskit.operators import covering, space

SHAPE = "code string, rings array<array<array<double>>>"


def even_odd(x, y, rings):
    odd, touch = np.zeros(len(x), bool), np.zeros(len(x), bool)
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            spans = (ay > y) != (by > y)
            with np.errstate(divide="ignore", invalid="ignore"):
                odd ^= spans & (x < ax + (y - ay) * (bx - ax) / np.where(by != ay, by - ay, 1.0))
            cross = (x - ax) * (by - ay) - (y - ay) * (bx - ax)
            touch |= (np.abs(cross) < 1e-12) & (x >= min(ax, bx)) & (x <= max(ax, bx)) & (y >= min(ay, by)) & (y <= max(ay, by))
    return odd | touch


def star(rng, cx, cy, n, low, high):
    return [[cx + (r := rng.uniform(low, high)) * math.cos(2 * math.pi * i / n), cy + 0.6 * r * math.sin(2 * math.pi * i / n)] for i in range(n)]


@pytest.mark.parametrize("degrees, crowded", [(1.0, 64), (10.0, 4), (0.5, 2), (90.0, 8)])
def test_points_meet_the_same_polygons_as_with_all_edges(spark, degrees, crowded):
    rng = random.Random(7)
    shapes = {
        "star": [star(rng, 10, 5, 60, 4, 30)], "holed": [[[0.0, 0.0], [20.0, 0.0], [20.0, 20.0], [0.0, 20.0]], [[5.0, 5.0], [15.0, 5.0], [15.0, 15.0], [5.0, 15.0]]],
        "beside": [[[20.0, 0.0], [40.0, 0.0], [40.0, 20.0], [20.0, 20.0]]], "twice": [[[0.0, 0.0], [10.0, 0.0], [10.0, 10.0]], [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0]]],
        "world": [[[-180.0, -90.0], [180.0, -90.0], [180.0, 90.0], [-180.0, 90.0]]], "sliver": [[[-50.0, -40.0], [60.0, 50.0], [60.0, 50.001]]], "closed": [[[-5.0, -5.0], [5.0, -5.0], [0.0, 8.0], [-5.0, -5.0]]],
    }
    points = [(rng.uniform(-60, 70), rng.uniform(-60, 60)) for _ in range(1500)] + [(float(x), float(y)) for x in range(-6, 42, 2) for y in range(-6, 24, 2)] + [(180.0, 90.0), (-180.0, -90.0), (20.0, 10.0), (5.0, 0.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)] + [(9999, None, None)], "record_id long, lon double, lat double")
    polygons = spark.createDataFrame(list(shapes.items()), SHAPE)
    got = covering.inside(df, space.edges(polygons), ["record_id"], degrees, crowded).collect()
    x, y = np.array(points).T
    want = {(i, code) for code, rings in shapes.items() for i in np.flatnonzero(even_odd(x, y, rings)).tolist()}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_a_polygon_of_100000_edges_leaves_few_in_any_cell(spark):
    rng = random.Random(3)
    ring = star(rng, 0, 0, 100_000, 39.9, 40.0)
    edge_table = space.edges(spark.createDataFrame([("big", [ring])], SHAPE))
    cells, sizes = covering.covering(edge_table)
    seen = cells.select(F.size("edges").alias("n"), "edges").agg(F.max("n").alias("most"), F.count("*").alias("cells"), F.count_if(F.col("edges").isNull()).alias("whole")).first()
    assert seen.most <= 64 * 4 and len(sizes) > 1 and seen.whole > 1000
    edge_cells = cells.filter("edges is not null").select("level", "cx", "cy", F.explode("edges").alias("e"))
    size = F.element_at(F.array(*[F.lit(d) for d in sizes]), F.col("level") + 1)
    west, south = covering.WEST + F.col("cx") * size, covering.SOUTH + F.col("cy") * size
    e = F.col("e")
    apart = (F.greatest(e["lon"], e["next_lon"]) < west - 1e-8) | (F.least(e["lon"], e["next_lon"]) > west + size + 1e-8) | (F.greatest(e["lat"], e["next_lat"]) < south - 1e-8) | (F.least(e["lat"], e["next_lat"]) > south + size + 1e-8)
    assert edge_cells.filter(apart).count() == 0
    points = [(rng.uniform(-41, 41), rng.uniform(-25, 25)) for _ in range(300)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "record_id long, lon double, lat double")
    got = {r.record_id for r in covering.inside(df, edge_table, ["record_id"]).collect()}
    assert got == set(np.flatnonzero(even_odd(*np.array(points).T, [ring])).tolist())


def test_empty_tables(spark):
    none = spark.createDataFrame([], SHAPE)
    one = spark.createDataFrame([("a", [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]]])], SHAPE)
    points = spark.createDataFrame([(1, 0.5, 0.2)], "record_id long, lon double, lat double")
    assert space.point_in_polygon(points, none).count() == 0 and space.point_in_polygon(points.limit(0), one).count() == 0
    assert [tuple(r) for r in space.point_in_polygon(points, one).collect()] == [(1, "a")]
