"""Tables laid out by place: the curve, the ranges of a box, the rows and the files that a box reads."""

import random

import pytest
from pyspark.sql import functions as F

from obskit.functions.standardize import inside_box
from obskit.sources import layout


def cell_number(lon, lat):
    x, y = (max(0, min((1 << 16) - 1, int((v + span / 2) // (span / (1 << 16))))) for v, span in ((lon, 360.0), (lat, 180.0)))
    return sum(((x >> i & 1) << 2 * i) | ((y >> i & 1) << 2 * i + 1) for i in range(16))


PLACES = [(-180.0, -90.0), (180.0, 90.0), (0.0, 0.0), (-0.0001, 12.0), (179.99, -89.99), (45.0, 22.5), (22.5, -11.25)]
PLACES += [(random.Random(i).uniform(-180, 180), random.Random(-i).uniform(-90, 90)) for i in range(1, 3000)]
BOXES = [(-180, -90, 180, 90), (10, 10, 12, 12), (170, -20, -170, 20), (45, 22.5, 45, 22.5), (-0.1, -0.1, 0.1, 0.1), (-90, -90, 0, 90), (179.5, 80, 180, 90)]


def test_curve(spark):
    df = spark.createDataFrame(PLACES, "lon double, lat double")
    assert [r.z for r in df.select(layout.curve(F.col("lon"), F.col("lat")).alias("z")).collect()] == [cell_number(*p) for p in PLACES]


@pytest.mark.parametrize("level", [1, 4, 6])
@pytest.mark.parametrize("box", BOXES)
def test_ranges_hold_the_box_and_little_else(box, level):
    west, south, east, north = box
    ranges = layout.tile_ranges(box, level)
    tile = lambda p: cell_number(*p) >> 2 * (16 - level)
    inside = {tile((x, y)) for x, y in PLACES if south <= y <= north and (west <= x <= east if west <= east else x >= west or x <= east)}
    held = {t for low, high in ranges for t in range(low, high + 1)}
    assert inside <= held and all(b[0] > a[1] + 1 for a, b in zip(ranges, ranges[1:]))
    width, height = (east - west) % 360 if west > east else east - west, north - south
    assert len(held) <= (width / (360 / 2**level) + 3) * (height / (180 / 2**level) + 2)


@pytest.fixture(scope="module")
def laid(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "t")
    rows = [(f"r{i}", ("soil", "rock", None)[i % 3], ("As", "1", "a/b=c")[i // 3 % 3], *p) for i, p in enumerate(PLACES)]
    rows += [(f"n{i}", "soil", "As", None, 1.0) for i in range(5)] + [(f"hot{i}", "soil", "As", 11.0, 11.0) for i in range(1500)]
    df = spark.createDataFrame(rows, "record_id string, medium string, element string, lon double, lat double")
    layout.write_by_place(df, path)
    return df, path


@pytest.mark.parametrize("box", BOXES)
@pytest.mark.parametrize("values", [{}, {"medium": ["soil"]}, {"element": ["1", "a/b=c"], "medium": [None, "rock"]}])
def test_rows_of_a_box(spark, laid, box, values):
    df, path = laid
    want = df.filter(inside_box(F.col("lon"), F.col("lat"), box))
    for k, vs in values.items():
        want = want.filter(F.col(k).isin(*[v for v in vs if v]) | (F.col(k).isNull() if None in vs else F.lit(False)))
    got = layout.read_by_place(spark, path, box, **values)
    assert got.columns == df.columns and got.dtypes == df.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_everything_comes_back(spark, laid):
    df, path = laid
    back = layout.read_by_place(spark, path)
    assert back.count() == df.count() and back.exceptAll(df).isEmpty()


def test_a_box_reads_few_files(spark, laid):
    _, path = laid
    name = F.input_file_name()
    every = {r[0] for r in spark.read.parquet(path).select(name).distinct().collect()}
    box, values = (10.0, 10.0, 12.0, 12.0), {"medium": ["soil"], "element": ["As"]}
    rows, *_ = layout._of_tiles(spark, path, box, values)
    few = {r[0] for r in rows.select(name).distinct().collect()}
    one_key, *_ = layout._of_tiles(spark, path, box, {})
    assert 0 < len(few) < len(every) / 100 and len({r[0] for r in one_key.select(name).distinct().collect()}) < len(every) / 10
    plan = layout.read_by_place(spark, path, box, **values)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(lon" in plan


def test_names_of_the_layout_are_taken(spark, tmp_path):
    df = spark.createDataFrame([("soil", "As", 1.0, 2.0, 3)], "medium string, element string, lon double, lat double, Tile int")
    with pytest.raises(ValueError, match="tile"):
        layout.write_by_place(df, str(tmp_path / "t"))
