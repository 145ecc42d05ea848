"""Verdicts of every line of evidence, counts around places against pairs, and candidate rules on cohorts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from obskit.operators import counting, provenance, reports, space

FLAGGED = "record_id string, sample_id string, source_id string, element string, medium string, direction string, lon double, lat double, lithology string"


def test_rectangle_sums_equal_pairs():
    for seed in range(30):
        rng = np.random.default_rng(seed)
        n, m = rng.integers(1, 200), rng.integers(1, 60)
        grid = [0.01, 0.1, 1.0][seed % 3]
        x, y = np.round(rng.uniform(-3, 3, n) / grid) * grid, np.round(rng.uniform(-3, 3, n) / grid) * grid
        w, qx, qy = rng.integers(0, 5, n), rng.choice(x, m), rng.choice(y, m)
        for reach in (0.1, 1.0, 2.0):
            near = (np.abs(x[None] - qx[:, None]) <= reach) & (np.abs(y[None] - qy[:, None]) <= reach)
            assert (counting.rectangle_sums(x, y, w, qx, qy, reach) == (near * w).sum(axis=1)).all()


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_counts_around_strips_and_blocks(spark, block):
    rng = random.Random(block)
    rows = list({(rng.choice(["a", None]), round(rng.uniform(-4, 4), 1), round(rng.uniform(-4, 4), 1)): rng.randint(0, 3) for _ in range(500)}.items())
    df = spark.createDataFrame([(*k, w) for k, w in rows], "`key 0` string, w double, strip double, part long")
    got = {(r[0], r[1], r[2]): r[3] for r in counting.counts_around(df, ["key 0"], "w", "strip", "part", 1.0, "sum", block).collect()}
    assert got == {(g, x, y): sum(v for (h, a, b), v in rows if h == g and abs(a - x) <= 1.0 and abs(b - y) <= 1.0) for (g, x, y), _ in rows}
    assert counting.counts_around(df.limit(0), ["key 0"], "w", "strip", "part", 1.0, "sum").count() == 0


def test_a_crowded_cell_is_counted_without_pairs(spark):
    """300,000 places in one square degree would make 9e10 pairs."""
    df = spark.range(300_000).select(F.lit("As").alias("element"), F.lit("soil").alias("medium"), F.lit("high").alias("direction"), F.col("id").cast("string").alias("record_id"), ((F.col("id") % 600) / 600).alias("lon"), (F.floor(F.col("id") / 600) / 500).alias("lat"))
    got = space.neighbor_count(df, 0.25).agg(F.min("neighbours").alias("least"), F.max("neighbours").alias("most"), F.count("*").alias("n"), F.max("peers").alias("peers")).first()
    assert got.n == got.peers == 300_000 and 0 < got.least < 38_500 < 75_000 < got.most < 76_500


def test_neighbours_leave_out_the_own_place_and_low_candidates(spark):
    spots = [("a", "high", 0.0, 0.0), ("b", "high", 0.0, 0.0), ("c", "high", 1.0, 0.5), ("d", "low", 0.5, 0.5), ("e", "high", 5.0, 5.0), ("f", "high", None, None), ("g", "low", 0.0, 0.0)]
    df = spark.createDataFrame([(i, i, "s", "As", "soil", d, x, y, None) for i, d, x, y in spots], FLAGGED).withColumns({"n": F.lit(1), "around": F.lit(2), "neighbours": F.lit("x")})
    got = {r.record_id: (r.neighbours, r.peers) for r in space.neighbor_count(df).collect()}
    assert got == {"a": (1, 4), "b": (1, 4), "c": (2, 4), "d": (3, 4), "e": (0, 4), "f": (None, 4), "g": (1, 4)}


def verdict(spark, column, kinds, rows):
    df = spark.createDataFrame(rows, kinds)
    return [r[0] for r in df.select(column).collect()]


def test_lithology_speaks_only_for_its_own_elements(spark):
    rows = [("Ni", "weathered Serpentinite"), ("As", "serpentinite"), ("Cu", "olivine basalt"), ("Zn", "basalt"), ("U", "Black Shale"), ("Ni", " "), ("Ni", None), (None, "basalt")]
    g, n, u = provenance.GEOGENIC, provenance.NEUTRAL, provenance.MISSING
    assert verdict(spark, provenance.lithology_line(F.col("l"), F.col("e")), "e string, l string", rows) == [g, n, g, n, g, u, u, n]


def test_spatial_and_association_lines(spark):
    g, h, n, u = provenance.GEOGENIC, provenance.HUMAN, provenance.NEUTRAL, provenance.MISSING
    assert verdict(spark, provenance.spatial_line(F.col("k"), F.col("p")), "k long, p long", [(2, 9), (1, 9), (0, 3), (0, 2), (None, 9)]) == [g, n, h, n, u]
    rows = [("Pb", ["Pb", "Zn"], ["Pb", "Zn"]), ("Pb", ["Pb", "Ni"], ["Pb", "Ni"]), ("Ni", ["Ni", "Cr"], ["Cr", "Ni"]), ("Cu", ["Cu", "Co"], ["Cu", "Co"]), ("Cu", ["Cu", "Co", "Zn"], ["Cu", "Co", "Zn"]), ("Ni", ["Ni", "Pb"], ["Ni", "Pb"]), ("Pb", ["Pb", "Zn"], ["Pb"]), ("Pb", ["Pb"], ["Pb"]), ("Pb", None, None)]
    got = verdict(spark, provenance.association_line(F.col("e"), F.col("m"), F.col("f")), "e string, m array<string>, f array<string>", rows)
    assert got == [h, n, g, g, h, n, n, u, u]


def test_temporal_line_and_stations(spark):
    series = {"rising": [1.0, 2.0, 3.0, 9.0], "falling": [9.0, 3.0, 2.0], "stable": [5.0, 5.1, 5.0, 5.2], "short": [1.0, 2.0], "negative": [-1.0, -2.0, -3.0], "edge": [1.0, 1.0, 1.0, 1.3]}
    rows = [(s, "As", 2000.0 + i, v) for s, vs in series.items() for i, v in enumerate(vs)] + [("once", "As", 2000.0, v) for v in (1.0, 2.0, 3.0)] + [("rising", "As", None, 0.0), ("rising", "Pb", 2000.0, 1.0)]
    df = spark.createDataFrame(rows, "station string, element string, t double, value double")
    got = {r.station: r.temporal_line for r in provenance.temporal_lines(df, df).collect()}
    assert got == {"rising": provenance.HUMAN, "falling": provenance.NEUTRAL, "stable": provenance.GEOGENIC, "edge": provenance.GEOGENIC}
    keyed = spark.createDataFrame([("s", "A|1", 1.234, 5.0), ("s", "A1", 1.234, 5.0), ("t", "A|1", 1.234, 5.0), ("s", "A1", None, 5.0)], "source_id string, sample_id string, lon double, lat double")
    assert [r[0] for r in keyed.select(provenance.station_key(keyed, {"s": "|"})).collect()] == ["station|s|A", "cell|s|5.0|1.23", "cell|t|5.0|1.23", None]


def test_classes_follow_the_lines(spark):
    obs = [("s1", "src", e, 0.0, 0.0, 1.0, None) for e in ("Pb", "Zn", "Ni")] + [("s2", "src", "Ni", 9.0, 9.0, v, t) for v, t in ((1.0, 2000.0), (1.0, 2001.0), (1.0, 2002.0))]
    obs += [("s3", "src", "Pb", 30.0, 30.0, v, t) for v, t in ((1.0, 2000.0), (4.0, 2001.0), (9.0, 2002.0))] + [("s4", "src", "Ni", 30.0, 60.0, v, t) for v, t in ((1.0, 2000.0), (4.0, 2001.0), (9.0, 2002.0))]
    flagged = [("a", "s1", "src", "Pb", "soil", "high", 0.0, 0.0, None), ("b", "s1", "src", "Zn", "soil", "high", 0.0, 0.0, None), ("c", "s2", "src", "Ni", "soil", "high", 9.0, 9.0, "gabbro"), ("d", "s3", "src", "Pb", "soil", "low", 30.0, 30.0, "granite")]
    flagged += [("e", "s3", "src", "Pb", "soil", "high", 30.0, 30.0, None), ("f", "x", "src", "Pb", "soil", "high", 60.0, 60.0, None), ("g", "s4", "src", "Ni", "soil", "high", 30.0, 60.0, "gabbro"), ("a", "s1", "src", "Pb", "soil", "high", 0.0, 0.0, None)]
    o = spark.createDataFrame(obs, "sample_id string, source_id string, element string, lon double, lat double, value double, t double")
    got = sorted((r.record_id, r["class"]) for r in provenance.anomaly_provenance(o, spark.createDataFrame(flagged, FLAGGED)).collect())
    # a, b: Pb and Zn together, a alone among its kind (e, f are far) -> two lines for people; b has too few of its kind.
    assert got == [
        ("a", "suspected_anthropogenic_input"), ("a", "suspected_anthropogenic_input"), ("b", "insufficient_evidence"), ("c", "geogenic_background"), ("d", "not_applicable_depletion"),
        ("e", "suspected_anthropogenic_input"), ("f", "insufficient_evidence"), ("g", "mixed_or_undistinguished"),
    ]


COHORTS = "element string, medium string, sample_type string, method_family string, tier string, quantified_samples long, sources long, top_source string, west double, east double, south double, north double"


def test_cohort_candidates(spark):
    def row(e, m, s, f, n, tier="analysis_ready", sources=1, top="a", box=(0.0, 1.0, 0.0, 1.0)):
        return (e, m, s, f, tier, n, sources, top, *box)

    rows = [
        row("Pb", "soil", "soil_topsoil", "xrf", 300), row("Pb", "soil", "soil_subsoil", "xrf", 90), row("Pb", "soil", "soil_humus", "xrf", 200), row("Pb", "soil", "soil_topsoil", "icp", 60), row("Pb", "soil", "soil_subsoil", "icp", 500, box=(5.0, 6.0, 0.0, 1.0)),
        row("Pb", "soil", "soil_c_horizon", "xrf", 900, tier="exploratory_only"), row("Pb", "water", "w", "icp", 250), row("Pb", "sediment", "sediment_outlet_top", "xrf", 49), row("As", "soil", "soil_topsoil", "xrf", 700, sources=2), row("As", "sediment", "x", "xrf", 260, top="b"),
        row("Zn", "soil", "soil_topsoil", "xrf", 450), row("Zn", "soil", "soil_humus", "xrf", 60, top="b"),
    ]
    df = spark.createDataFrame(rows, COHORTS)
    pair = provenance.cohort_pair_candidates(df).collect()
    assert [(r.element, r.medium, r.method_family, r.s_sample_type, r.d_sample_type, r.score) for r in pair] == [("Pb", "soil", "xrf", "soil_topsoil", "soil_subsoil", 390)]
    gaps = spark.createDataFrame([("north", "k"), ("north", "l"), (None, "k")], "region string, key string")
    got = sorted(tuple(r) for r in reports.discovery_candidates(df, gaps).collect())
    assert got == [("T2", "Pb|soil|soil_subsoil", 590), ("T2", "Pb|soil|soil_topsoil", 360), ("T3", "Pb|soil", 1150), ("T4", "north", 2), ("T4", "unknown", 1), ("T5", "As|soil|sediment", 960), ("T5", "Pb|soil|water", 1400)]


def test_station_points_are_ordered_and_chunked(spark):
    rng = random.Random(1)
    rows = [("s", "As", rng.choice(["mg", "mg", "ug"]), float(rng.randint(0, 400)), rng.random()) for _ in range(900)] + [("t", "As", "mg", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "station string, element string, unit string, t double, value double")
    got = provenance.station_points(df, size=100).orderBy("chunk").collect()
    points = [tuple(p) for r in got for p in r.points]
    assert points == sorted((t, v) for s, _, u, t, v in rows if s == "s" and u == "mg") and all(len(r.points) == 100 for r in got[:-1])
