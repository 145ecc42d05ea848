"""The whole run against its parts, and the odd rows that operators must stand."""

import pytest
from pyspark.sql import functions as F

from obskit.functions import standardize as S
from obskit.operators import rows, sampling, screening, workflow

TEXT = "record_id string, sample_id string, source_id string, source_row string, element_or_analyte string, value string, value_qualifier string, source_qualifier_raw string, detection_limit string, quantitation_limit string, missing_reason string, unit string, medium string, species_or_oxide string, latitude string, longitude string, source_crs string, sample_depth_min_m string, sample_depth_max_m string, analytical_method string, method_family string, measurement_basis string, source_tier string, sampled_at string, batch_id string"


def raw_row(i, **more):
    base = dict(record_id=f"r{i}", sample_id=f"s{i}", source_id="src-a", source_row=str(i), element_or_analyte="As", value=str(10 + i % 7), unit="mg/kg", medium="soil", latitude="10.5", longitude="20.25", source_crs="EPSG:4326", analytical_method="ICP-MS", measurement_basis="total", source_tier="government", sampled_at="2001-02-03", batch_id="B1")
    return {**dict.fromkeys(n.split()[0] for n in TEXT.split(", ")), **base, **more}


@pytest.fixture(scope="module")
def whole(spark):
    data = [raw_row(i) for i in range(60)]
    data += [raw_row(100, value="90000"), raw_row(101, value="<0.5"), raw_row(102, value=None), raw_row(103, value="bad", latitude="95"), raw_row(104, batch_id="B2"), raw_row(105, batch_id=None, source_crs=None)]
    data += [raw_row(106, record_id="dup1", sample_id="same", value="11"), raw_row(106, record_id="dup2", sample_id="same", value="11")] + [dict.fromkeys(data[0])]
    raw = spark.createDataFrame([tuple(d.values()) for d in data], TEXT)
    formats = spark.createDataFrame([("src-a", "iso_partial")], "source_id string, raw_format string")
    acceptance = spark.createDataFrame([("B1", "pass"), ("B2", "fail")], "batch_id string, status string")
    return raw, formats, acceptance


def test_whole_run_keeps_every_row_and_agrees_with_its_parts(spark, whole):
    raw, formats, acceptance = whole
    out = workflow.run(raw, formats, acceptance).collect()
    assert len(out) == raw.count() and len({r.stable_id for r in out}) == len(out)
    got = {r.record_id: r for r in out}
    parts = {r.record_id: r for r in S.standardize(raw.withColumn("k", F.lit(1))).collect()}
    for k, r in got.items():
        p = parts[k]
        assert (r.analyte, r.number, r.qualifier, r.normalized_value, r.normalized_limit, r.latitude, r.longitude) == (p.analyte, p.number, p.qualifier, p.normalized_value, p.normalized_limit, p.lat_value, p.lon_value)
        assert set(p.qc_flags) <= set(r.qc_flags)
    assert [k for k, r in got.items() if r.direction] == ["r100"] and got["r100"].direction == "high" and got["r100"].robust_z > 3.5
    assert got["dup1"].duplicate and "DUPLICATE_CANDIDATE" in got["dup2"].qc_flags and not got["r1"].duplicate
    assert got["r104"].batch_status == "fail" and "BATCH_QC_FAILED" in got["r104"].qc_flags and got["r104"].confidence.overall <= 0.59 < got["r1"].confidence.qc
    assert got["r105"].batch_status == "incomplete" and "MISSING_ANALYSIS_BATCH_ID" in got["r105"].batch_flags and got["r105"].latitude is None
    assert got["r101"].normalized_limit == 0.5 and got["r101"].normalized_value is None and got["r1"].method_family == "icp_ms"
    ungated = {r.record_id: r for r in workflow.run(raw, formats).collect()}
    assert ungated["r100"].direction == "high" and "batch_status" not in ungated["r1"].asDict()
    assert workflow.run(raw.limit(0), formats, acceptance).count() == 0


def test_identity_falls_back_on_context(spark):
    columns = "source_id string, sample_id string, value string, unit string, latitude string, sampled_at string, duplicate string, digest int"
    data = [("a", None, "1", "u", "5", "2001", "x", 1), ("a", "", "1", "u", "5", "2001", "x", 2), ("a", None, "1", "u", "5", "2002", "x", 3), ("a", "s", "1", "u", "5", "2001", "x", 4), ("a", "s", "1", "u", "5", "2009", "x", 5), (None, None, None, None, None, None, None, 6)]
    got = {r.digest: r.duplicate for r in screening.duplicate_candidates(spark.createDataFrame(data, columns)).collect()}
    assert got == {1: True, 2: True, 3: False, 4: True, 5: True, 6: False}


def test_positions_and_quotas(spark):
    df = spark.createDataFrame([(float(i % 10), f"k{i:03d}", "p", 7) for i in range(100)] + [(None, "z", "p", 7)], "x double, id string, position string, r int")
    got = sorted((r.position, r.x, r.id) for r in sampling.with_positions(df, ["x", "id"]).collect())
    want = sorted((r for r in df.collect()), key=lambda r: (r.x is None, r.x or 0, r.id))
    assert [g[1:] for g in got] == [(r.x, r.id) for r in want] and [g[0] for g in got] == list(range(1, 102))
    assert sampling.water_fill({"a": 3, "b": 100, "c": 100}, 50) == {"a": 3, "b": 24, "c": 23}
    uneven = spark.createDataFrame([("a", i) for i in range(3)] + [(None, i) for i in range(40)] + [("c", i) for i in range(40)], "medium string, n int")
    kept = sampling.balanced_cap(uneven, 20, ["n"]).collect()
    assert len(kept) == 20 and sum(r.medium == "a" for r in kept) == 3 and max(r.n for r in kept) <= 8
    layers = sampling.balanced_layer_sample(uneven, "medium", 10, ["n"], F.col("n") == 30).collect()
    assert sorted((r.medium or "", r.n) for r in layers) == sorted([("a", 0), ("a", 1), ("a", 2), ("", 30), ("", 0), ("", 1), ("c", 30), ("c", 0), ("c", 1)])


def test_empty_tables_and_null_rows(spark):
    columns = "record_id string, source_id string, sample_id string, element string, medium string, unit string, qualifier string, value double, censor_limit double, lon double, lat double, url string, doi string, title string, version string, license string, lithology string, domain string, basis string, method_family string, method_scope string, sample_type string, band string, crs string, qc_flags array<string>"
    nothing = spark.createDataFrame([], columns)
    nulls = spark.createDataFrame([tuple([None] * 25)] * 3, columns)
    for df, n in ((nothing, 0), (nulls, 3)):
        assert rows.evidence_layer(df, ["X"]).count() == n
        assert {r.layer for r in rows.evidence_layer(df, ["X"]).collect()} <= {"incomplete"}
        assert rows.row_issues(df).select("record_id").distinct().count() == min(n, 1)
        assert screening.anomaly_group_report(df, ["element", "medium", "unit"]).count() == min(n, 1)
        assert screening.robust_anomalies(df, ["element", "medium", "unit"]).count() == 0
