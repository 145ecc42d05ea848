"""Files hashed in blocks, positions by ranges, samples that cover every grid size from one aggregate."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from obskit.operators import ranking, reports, sampling
from obskit.operators.space import cell_index
from obskit.sources import tables


def plain_digest(path):
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 24):
            digest.update(block)
    return digest.hexdigest()


def manifest(spark, folder, **how):
    return sorted(tuple(r) for r in tables.file_manifest(spark, f"{folder}/*", **how).collect())


def test_manifest_of_many_files(spark, tmp_path):
    for i, content in enumerate((b"", b"a", b"\x00\xff" * 700, os.urandom(1000), os.urandom(99_999))):
        for j in range(12):
            (tmp_path / f"f{i}-{j}.bin").write_bytes(content + bytes([j]) * (i and j))
    (tmp_path / "odd name%20+ü.bin").write_bytes(b"x" * 3000)
    want = sorted((p.name, p.stat().st_size, plain_digest(p)) for p in tmp_path.iterdir())
    assert len(want) == 61
    for least in (0, 1000, 1 << 40):
        assert manifest(spark, tmp_path, in_blocks_from=least) == want


def test_manifest_of_a_file_over_two_gigabytes(spark, tmp_path):
    path = tmp_path / "sparse.bin"
    with open(path, "wb") as f:
        f.write(b"head")
        f.truncate(3 << 30)
    assert manifest(spark, tmp_path) == [("sparse.bin", 3 << 30, plain_digest(path))]


@pytest.mark.parametrize("parts", [1, 7])
def test_positions_by_ranges(spark, parts):
    rows = [(i % 3, (i * 37) % 101 if i % 11 else None, f"k{i}", "kept") for i in range(500)]
    df = spark.createDataFrame(rows, "kind int, n int, key string, place string").repartition(parts)
    out = ranking.numbered(df, ["kind", F.desc("n"), "key"], "position")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    want = sorted(rows, key=lambda r: (r[0], r[1] is None, -(r[1] or 0), r[2]))
    assert [tuple(r)[:4] for r in out.orderBy("position").collect()] == want
    assert [r.position for r in out.orderBy("position").collect()] == list(range(1, 501))
    assert ranking.numbered(df.limit(0), ["kind", "key"], "position").collect() == []


def test_priority_has_no_single_task(spark):
    gaps = spark.createDataFrame([(f"v{i % 3}", f"k{i}", "z", 1.0, 2.0, 3.0, 4.0) for i in range(50)], "view string, key string, zone string, west double, south double, east double, north double")
    cohorts = spark.createDataFrame([tuple("c" + str(i) for _ in reports.COHORT) + (i % 2 + 1, i % 5, 1.0, 2.0, 3.0, 4.0) for i in range(40)], ", ".join(f"{c} string" for c in reports.COHORT) + ", sources long, quantified long, west double, south double, east double, north double")
    out = reports.sampling_priority(gaps, cohorts)
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.orderBy("priority").collect()
    assert [r.priority for r in rows] == list(range(1, 71)) and [r.task for r in rows] == ["fill_zone"] * 50 + ["second_source"] * 20
    assert [r.key for r in rows[:50]] == sorted(r.key for r in rows[:50])


def per_size(obs, flagged, limit, strata, degrees, seed=5):
    """The sample counted anew for every grid size."""
    h = sampling.unit_hash(F.col("sample_id"), seed)
    sizes = {r.sample_id: (r.n, r.h) for r in obs.groupBy("sample_id").agg(F.count("*").alias("n")).withColumn("h", h).collect()}
    must = {r.sample_id for r in flagged.collect()}
    for d in (*degrees, None):
        x, y = cell_index(F.col("lon"), F.col("lat"), d or 360.0)
        cell = F.when(F.col("lon").isNotNull(), y * 100_000 + x) if d else F.lit(0)
        first = {}
        for r in obs.select("sample_id", F.struct(*strata, cell.alias("cell")).alias("g")).collect():
            first[r.g] = min(first.get(r.g, (1 << 62, "")), (sizes[r.sample_id][1], r.sample_id))
        forced = must | {s for _, s in first.values()}
        if sum(sizes[s][0] for s in forced if s in sizes) <= limit:
            break
    kept, running = set(forced), sum(sizes[s][0] for s in forced if s in sizes)
    for _, s in sorted((v[1], s) for s, v in sizes.items() if s not in forced):
        running += sizes[s][0]
        if running <= limit:
            kept.add(s)
    return kept & set(sizes)


@pytest.mark.parametrize("limit", [0, 40, 90, 150, 10_000])
@pytest.mark.parametrize("degrees", [(1.0, 2.0, 5.0, 30.0), (3.0, 7.0), ()])
def test_every_grid_size_at_once(spark, limit, degrees):
    rows = [(f"s{i % 130}", None if i % 9 == 0 else (i * 7.3) % 360 - 180, (i * 3.1) % 180 - 90, f"m{i % 3}" if i % 8 else None) for i in range(400)]
    obs = spark.createDataFrame(rows, "sample_id string, lon double, lat double, medium string")
    flagged = spark.createDataFrame([("s3",), ("s77",), ("other",)], "sample_id string")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    out = sampling.coverage_preserving_sample(obs, flagged, limit, ["medium"], degrees)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    assert {r.sample_id for r in out.collect()} == per_size(obs, flagged, limit, ["medium"], degrees)
