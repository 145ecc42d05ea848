"""Sampling times, measurements and checks on small tables by hand."""

import math

import pytest
from pyspark.sql import functions as F

from obskit.functions import standardize, times
from obskit.operators import provenance, screening


def test_sampling_times(spark):
    cases = [
        ("iso8601", "1999", "1999", "year"), ("iso8601", "1999-07", "1999-07", "month"), ("iso8601", "1999-13", None, None), ("iso8601", "2000-02-29", "2000-02-29", "day"),
        ("iso8601", "1999-02-29", None, None), ("iso8601", "1999-02-28T10:05", "1999-02-28T10:05", "minute"), ("iso8601", "1999-02-28 10:05:07Z", "1999-02-28T10:05:07", "second"),
        ("iso8601", "1999-02-28T24:05", None, None), ("iso8601", "1850-01-01", None, None), ("dmy_slash", "7/3/1999", "1999-03-07", "day"), ("dmy_slash", "31/2/1999", None, None),
        ("mdy_slash_2digit", "3/7/49", None, None), ("mdy_slash_2digit", "3/7/24", "2024-03-07", "day"), ("mdy_slash_2digit", "3/7/50", "1950-03-07", "day"), ("year", "1899", None, None),
        ("year", " 2035 ", "2035", "year"), ("year_range_slash", "1999/2003", "1999/2003", "year_range"), ("year_range_slash", "2003/1999", None, None), ("excel_serial_day", "36161", "1999-01-01", "day"),
        ("excel_serial_day", "1", None, None), ("dmy_dot_2digit_or_excel_serial", "7.3.99", "1999-03-07", "day"), ("dmy_dot_2digit_or_excel_serial", "36161", "1999-01-01", "day"),
        ("iso8601", None, None, None), ("iso8601", " ", None, None), ("unheard_of", "1999", None, None),
    ]
    rows = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(cases)], "i int, source_id string, sampled_at string")
    formats = rows.select("source_id", F.col("source_id").alias("raw_format")).distinct()
    found = {r.i: r for r in times.normalize_sampling_time(rows, formats).collect()}
    assert [(found[i].sampling_time, found[i].sampling_time_precision) for i in range(len(cases))] == [(c[2], c[3]) for c in cases]
    assert {found[i].sampling_time_status for i in (22, 23)} == {"not_reported"} and found[3].sampling_time_status == "reported" and found[24].sampling_time_status == "unparseable"


@pytest.mark.parametrize(
    ("time", "precision", "start", "end"),
    [("2000", "year", 2000, 2001), ("1999/2003", "year_range", 1999, 2004), ("2000-02", "month", 2000 + 31 / 366, 2000 + 60 / 366), ("1999-12-31", "day", 1999 + 364 / 365, 2000), ("1999-01-01T10:00", "minute", 1999, 1999 + 1 / 365)],
)
def test_intervals(spark, time, precision, start, end):
    i = spark.createDataFrame([(time, precision)], "t string, p string").select(times.time_interval(F.col("t"), F.col("p")).alias("i")).first().i
    assert (i.start, i.end) == pytest.approx((start, end)) and i.mid == pytest.approx((start + end) / 2)


def test_measurements(spark):
    names = ["value", "value_qualifier", "source_qualifier_raw", "detection_limit", "quantitation_limit", "missing_reason"]
    rows = [("1,234", None, None, None, None, None), ("<0.5", None, None, "x", None, None), ("<LOD", None, None, "0.2", None, None), ("ND", None, None, None, None, None), ("bad", None, None, None, "-1", None), (None, None, None, None, None, "lost"), ("-3", None, None, None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{n} string" for n in names))
    out = standardize.parse_measurement(df)
    assert out.columns[:7] == ["i", *names] and not [c for c in out.columns if c.startswith("_")]
    got = {r.i: r for r in out.collect()}
    assert got[0].number == 1234 and got[0].qualifier == "reported" and got[0].value_flags == []
    assert (got[1].number, got[1].qualifier, got[1].censoring_limit) == (0.5, "lt", 0.5) and "INVALID_DETECTION_LIMIT" in got[1].value_flags
    assert (got[2].number, got[2].censoring_limit) == (None, 0.2) and "CENSORED_VALUE" in got[2].value_flags
    assert "NONDETECT_WITHOUT_LIMIT" in got[3].value_flags
    assert got[4].missing_reason_value == "invalid_value" and {"INVALID_NUMERIC_VALUE", "INVALID_QUANTITATION_LIMIT"} <= set(got[4].value_flags)
    assert got[5].missing_reason_value == "unknown" and "INVALID_MISSING_REASON" in got[5].value_flags
    assert got[6].number == -3 and "NEGATIVE_CONCENTRATION" in got[6].value_flags


def test_hypergeometric_tail(spark):
    df = spark.createDataFrame([(3, 20, 5, 6), (0, 20, 5, 6), (6, 20, 5, 6)], "x int, n int, k int, m int")
    got = [r.p_value for r in screening.hypergeometric_survival(df, "x", "n", "k", "m").orderBy("x").collect()]
    want = sum(math.comb(5, i) * math.comb(15, 6 - i) for i in (3, 4, 5)) / math.comb(20, 6)
    assert got == pytest.approx([1.0, want, 0.0])


def test_step_up_values(spark):
    df = spark.createDataFrame([(0.01,), (0.04,), (0.04,), (0.9,)], "p double")
    got = sorted(r.q_value for r in screening.benjamini_hochberg(df, "p").collect())
    assert got == pytest.approx([0.04, 0.16 / 3, 0.16 / 3, 0.9])


def test_batches_of_every_outcome(spark):
    def batch(name, crm=100.0, blank=1.0, pair=(50.0, 52.0)):
        return [(name, "CRM", 1, crm, 100.0, None), (name, "BLANK", 2, blank, None, None), (name, "DUPLICATE", 3, pair[0], None, 9), (name, "DUPLICATE", 4, pair[1], None, 9)]

    rows = batch("good", crm=120.0, blank=5.0) + batch("crm", crm=121.0) + batch("blank", blank=5.1) + batch("pair", pair=(40.0, 60.0)) + batch("part")[:2]
    df = spark.createDataFrame(rows, "batch_id string, qc_type string, qc_id int, value double, certified_value double, pair_id int")
    got = {r.batch_id: r.status for r in screening.batch_qc(df).collect()}
    assert got == {"good": "pass", "crm": "fail", "blank": "fail", "pair": "fail", "part": "incomplete"}


def test_checks_find_exactly_what_was_planted(spark):
    obs = spark.createDataFrame([(f"r{i}", "s", 1.0 * i, 2.0) for i in range(6)], "record_id string, source_id string, lon double, lat double")
    assert provenance.evidence_reconcile(obs, obs, ["lon"]).count() == 0
    changed = obs.filter("record_id <> 'r0'").withColumn("lon", F.when(F.col("record_id") == "r3", 77.0).otherwise(F.col("lon")))
    assert {r.record_id for r in provenance.evidence_reconcile(obs, changed, ["lon"]).collect()} == {"r0", "r3"}
    assert {r.record_id for r in provenance.evidence_orphans(obs, changed, spark.createDataFrame([("s",)], "source_id string")).collect()} == {"r0"}
    assert {r.record_id for r in provenance.artifact_coordinate_check(obs, changed).collect()} == {"r3"}


def test_derived_values_and_censoring(spark):
    rows = [("a", "soil", "mg/kg", 2.0, "ppb", 2000.0, None), ("b", "soil", "mg/kg", 3.0, "ppb", 2000.0, None), ("c", "water", "mg/kg", 2.0, "ppb", 2000.0, None), ("d", "soil", "mg/kg", 2.0, "ppb", 2000.0, "lt")]
    obs = spark.createDataFrame(rows, "record_id string, medium string, unit string, value double, original_unit string, original_value double, qualifier string")
    got = {r.record_id: r.problem for r in screening.unit_rederive_check(obs, {"ppb": 0.001}).collect()}
    assert got == {"b": "value_differs", "c": "phase_flip"}
    listed = spark.createDataFrame([("a",), ("d",)], "record_id string")
    assert {(r.record_id, r.problem) for r in screening.censor_guard_check(obs, listed).collect()} == {("d", "censored_with_value"), ("d", "censored_listed")}
