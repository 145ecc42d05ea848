"""A table's own columns survive every operator that returns its rows, whatever they are called."""

import pytest
from pyspark.sql import functions as F

from obskit.functions import standardize as S
from obskit.functions import times
from obskit.functions.names import fresh
from obskit.operators import paired, provenance, rows, sampling, screening, space, workflow

OWN = ("_s", "_k", "_n", "_v", "_z", "_p", "_over", "_size", "_b", "_t", "_o", "_w", "_side", "_reason", "_row", "_col", "_sid", "_crs", "_plain", "_word", "_unit", "_name", "_a", "_c", "_first", "row", "v", "n", "k", "f", "z", "h", "log", "why", "key 0", "right batch_id", "before", "digest", "neighbours_", "high", "around")


@pytest.fixture(scope="module")
def table(spark):
    rows_ = [(f"r{i}", f"s{i % 9}", f"src-{i % 2}", ["As", "Pb"][i % 2], ["soil", "water"][i % 3 == 0], str(i + 1), float(i + 1), "reported", "mg/kg", i % 7 * 1.0, i % 5 * 1.0, f"B{i % 3}", i) for i in range(60)]
    df = spark.createDataFrame(rows_, "record_id string, sample_id string, source_id string, element string, medium string, text string, value double, qualifier string, unit string, lon double, lat double, batch_id string, source_row int")
    return df.withColumns({"direction": F.when(F.col("source_row") % 2 == 0, "high").otherwise("low"), "lithology": F.lit("basalt"), "sampled_at": F.lit("2001-02-03"), "domain": F.lit("land"), "uncertainty_m": F.lit(5.0), "doi": F.lit("10.1/x")})


def raw(df):
    names = ("value_qualifier", "source_qualifier_raw", "detection_limit", "quantitation_limit", "missing_reason", "species_or_oxide")
    return df.withColumns({"value": F.col("text"), "element_or_analyte": F.col("element"), **{n: F.lit(None).cast("string") for n in names}})


def accepted(df):
    return df.sparkSession.createDataFrame([("B0", "pass"), ("B1", "fail")], "batch_id string, status string")


def policies(df):
    return df.sparkSession.createDataFrame([("src-0", "^10", ["lat", "lon"], "EPSG:4326")], "source_id string, doi_pattern string, fields array<string>, crs string")


def formats(df):
    return df.sparkSession.createDataFrame([("src-0", "iso_date")], "source_id string, raw_format string")


def raster(df):
    return df.sparkSession.createDataFrame([(180, 360, 7)], "row int, col int, class_id int")


OPERATORS = {
    "parse_measurement": lambda d: S.parse_measurement(raw(d)), "resolve_analyte": lambda d: S.resolve_analyte(raw(d)), "unit_conversion": lambda d: S.unit_conversion(d, analyte="element", species="lithology"),
    "normalize_sampling_time": lambda d: times.normalize_sampling_time(d, formats(d)), "apply_batch_gate": lambda d: screening.apply_batch_gate(d, accepted(d)), "robust_anomalies": lambda d: screening.robust_anomalies(d, ["medium"], z=0.1),
    "duplicate_candidates": lambda d: screening.duplicate_candidates(d, ["sample_id"]), "top_k_per_group": lambda d: sampling.top_k_per_group(d, ["medium"], ["source_row"], 3), "balanced_cap": lambda d: sampling.balanced_cap(d, 9, ["source_row"]),
    "with_positions": lambda d: sampling.with_positions(d, ["source_row"]), "evenly_spaced_sample": lambda d: sampling.evenly_spaced_sample(d, 7, ["source_row"]), "round_robin_sample": lambda d: sampling.round_robin_sample(d, "element", ["medium"], ["source_row"], 5, 2),
    "balanced_layer_sample": lambda d: sampling.balanced_layer_sample(d, "medium", 5, ["source_row"], F.col("lon") > 3), "with_running_sum": lambda d: sampling.with_running_sum(d.withColumns({"hash": F.col("source_row").cast("bigint")}), ["source_row", "hash"], "value"),
    "coordinate_policy_join": lambda d: rows.coordinate_policy_join(d.withColumns({"source_crs": F.lit(None).cast("string"), "lat_field": F.lit("lat"), "lon_field": F.lit("lon")}), policies(d)), "with_stable_ids": lambda d: rows.with_stable_ids(d, ["sample_id"], "source_row"),
    "request_filter": lambda d: rows.request_filter(d, {"elements": ["As"]})[0], "raster_cell_join": lambda d: space.raster_cell_join(d, raster(d)), "neighbor_count": lambda d: space.neighbor_count(d),
    "compact_evidence": lambda d: provenance.compact_evidence(d, ["source_id"], ["lithology", "doi"], "record_id"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_own_columns_survive(table, name):
    plain = OPERATORS[name](table)
    own = table.withColumns({c: F.concat(F.lit(f"{c}:"), "record_id") for c in OWN})
    out = OPERATORS[name](own)
    assert set(out.columns) == set(plain.columns) | set(OWN)
    got = out.select("record_id", *[F.col(f"`{c}`") for c in OWN]).collect()
    assert sorted(r.record_id for r in got) == sorted(r.record_id for r in plain.select("record_id").collect()) and got
    assert all(r[c] == f"{c}:{r.record_id}" for r in got for c in OWN)


def test_aggregates_take_clashing_keys(table):
    own = table.withColumns({"_side": F.col("sample_id"), "_v": F.lit(1)})
    assert paired.median_pair(own, ["_side"], F.col("element"), "As", "Pb").columns[0] == "_side"
    assert sampling.top_k_per_group(own.withColumn("_k", F.col("medium")), ["_k"], ["source_row"], 2).count() == 4


def test_whole_run_keeps_own_columns(table):
    own = raw(table).withColumns({c: F.concat(F.lit(f"{c}:"), "record_id") for c in ("_s", "_k", "_n", "v", "n", "row", "log", "why")}).withColumns({c: F.lit(None).cast("string") for c in ("longitude", "latitude", "sample_depth_min_m", "sample_depth_max_m")})
    out = workflow.run(own, formats(table), accepted(table)).collect()
    assert len(out) == 60 and all(r[c] == f"{c}:{r.record_id}" for r in out for c in ("_s", "_k", "_n", "v", "n", "row", "log", "why"))


def test_fresh_names_are_new():
    assert fresh(["a", "A_", "b"], "a", "b", "c", "a") == ("a__", "b_", "c", "a___")
