"""The whole run reads its rows once, shuffles none of them by keys, and computes no text or rule twice."""

import pytest
from pyspark.sql import functions as F

from obskit.functions import standardize as S
from obskit.functions import times
from obskit.operators import rows, screening, workflow
from obskit.sources.storage import small_splits
from tests.test_workflow import TEXT, raw_row


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_whole_run_reads_rows_once_and_joins_small_tables_only(spark):
    data = [raw_row(i, element_or_analyte=("As", "Pb")[i % 2]) for i in range(60)] + [raw_row(99, value="90000")] + [raw_row(7, record_id=f"again{k}", value="11", sample_id="one") for k in (3, 1, 2)]
    raw = spark.createDataFrame([tuple(d.values()) for d in data], TEXT)
    formats = spark.createDataFrame([("src-a", "iso8601")], "source_id string, raw_format string")
    acceptance = spark.createDataFrame([("B1", "pass")], "batch_id string, status string")
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    columns = ["record_id", F.col("stable_id").alias("id"), F.concat_ws(",", "qc_flags").alias("flags"), F.col("confidence.overall").alias("overall"), "sampling_time"]
    out = workflow.run(raw.mapInArrow(count, raw.schema), formats, acceptance, columns=columns)
    assert out.columns == ["record_id", "id", "flags", "overall", "sampling_time", "robust_z", "direction"]
    got = {r.record_id: r for r in out.collect()}
    assert read.value == len(data) and "Exchange hashpartitioning" not in plan(out) and "SortMergeJoin" not in plan(out)
    whole = {r.record_id: r for r in workflow.run(raw, formats, acceptance).collect()}
    assert set(got) == set(whole) == {d["record_id"] for d in data}
    for k, w in whole.items():
        assert tuple(got[k]) == (k, w.stable_id, ",".join(w.qc_flags), w.confidence.overall, w.sampling_time, w.robust_z, w.direction)
    assert [k for k, r in got.items() if r.direction] == ["r99"] and got["r1"].sampling_time == "2001-02-03"
    assert [got[f"again{k}"].id[-2:] for k in (1, 2, 3)] == ["-1", "-2", "-3"] and "DUPLICATE_CANDIDATE" in got["again1"].flags


@pytest.mark.parametrize("kinds", [1, 7, 400])
def test_repeats_by_hash(spark, kinds):
    data = [(i, f"a{i % kinds}" if i % 5 else None, "b" if i % 3 else "", f"r{i % 50:02d}") for i in range(600)]
    df = spark.createDataFrame(data, "place long, a string, b string, record_id string")
    times_ = {}
    for _, a, b, _ in data:
        times_[a, b] = times_.get((a, b), 0) + 1
    got = screening.duplicate_candidates(df, ["a", "b"]).collect()
    assert len(got) == 600 and all(r.duplicate == (times_[r.a, r.b] > 1) for r in got)
    by_window = rows.with_stable_ids(df, ["a", "b"], "record_id")
    by_hash = rows.with_stable_ids(df, ["a", "b"], "record_id", "place")
    assert by_hash.columns == by_window.columns and by_hash.schema["occurrence"].dataType == by_window.schema["occurrence"].dataType
    pick = lambda d: sorted((r.stable_id, r.occurrence, r.record_id) for r in d.collect())
    assert pick(by_hash) == pick(by_window)


def test_duplicates_with_the_same_hash_are_told_apart(spark):
    """xxhash64 passes over nulls, so these keys share a hash."""
    df = spark.createDataFrame([("x", None), (None, "x"), ("y", None), ("y", None), (None, "y")], "a string, b string")
    assert df.select(F.xxhash64("a", "b").alias("h")).distinct().count() == 2
    got = [(r.a, r.b, r.duplicate) for r in screening.duplicate_candidates(df, ["a", "b"]).collect()]
    assert sorted(got, key=str) == sorted([("x", None, False), (None, "x", False), ("y", None, True), ("y", None, True), (None, "y", False)], key=str)


def test_duplicates_shuffle_no_rows(spark):
    df = spark.range(50_000).select("id", F.repeat(F.col("id").cast("string"), 20).alias("text"), (F.col("id") / 2).cast("long").cast("string").alias("half"))
    out = screening.duplicate_candidates(df.filter("id > 3").unionByName(df.filter("id < 5")), ["text"])
    assert "SortMergeJoin" not in plan(out) and "Exchange hashpartitioning" not in plan(out)
    assert sorted(r.id for r in out.filter("duplicate").collect()) == [4, 4]


def test_scores_where_rows_lie(spark):
    obs = spark.createDataFrame([(f"r{i}", None if i % 2 else "g", "lt" if i % 50 == 9 else "reported", None if i == 5 else 10.0 ** (i % 7 / 10 + (5 if i in (8, 9) else -5 if i == 11 else 0)), "own") for i in range(200)], "record_id string, g string, qualifier string, v double, median string")
    plainly = obs.withColumnRenamed("v", "value")
    out = screening.robust_scores(obs, screening.anomaly_group_report(plainly, ["g"]), ["g"], value="v")
    assert "SortMergeJoin" not in plan(out) and out.columns == [*obs.columns, "robust_z", "direction"] and out.count() == 200
    hits = {(r.record_id, r.robust_z, r.direction) for r in out.filter("direction is not null").collect()}
    assert hits == {(r.record_id, r.robust_z, r.direction) for r in screening.robust_anomalies(plainly, ["g"]).collect()} and {h[0] for h in hits} == {"r8", "r11"}


def test_rules_are_compiled_and_texts_made_once(spark):
    raw = spark.createDataFrame([tuple(raw_row(1).values())], TEXT)
    for out in (S.standardize(raw), S.with_method_family(raw)):
        optimized = out._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in optimized and optimized.count("_common_expr") < 20
    assert S.with_method_family(raw).first().method_family == "icp_ms"
    scored = S.confidence_score(workflow.run(raw, spark.createDataFrame([("src-a", "iso8601")], "source_id string, raw_format string")).withColumn("qc_flags", F.array(F.lit("INVALID_NUMERIC_VALUE"))))
    assert scored.first().confidence.overall <= 0.59 and "error_qc_low_cap" in scored.first().confidence.gates
    nothing = S.flags(("A", F.lit(False)), ("B", F.lit(None).cast("boolean")))
    both = S.flags(("A", F.lit(True)), ("B", F.lit(False)), ("C", F.lit(True)), ("A", F.lit(True)))
    assert tuple(spark.range(1).select(nothing.alias("a"), both.alias("b")).first()) == ([], ["A", "C"])


def test_formats_shuffle_no_rows(spark):
    formats = spark.createDataFrame([("s1", "iso8601")], "source_id string, raw_format string")
    df = spark.range(3_000_000).select(F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("source_id"), F.lit("2001-02").alias("sampled_at"))
    assert "SortMergeJoin" not in plan(times.normalize_sampling_time(df, formats))


def test_whole_run_spreads_rows_without_a_shuffle(spark, monkeypatch):
    raw = spark.createDataFrame([tuple(raw_row(i).values()) for i in range(40)], TEXT)
    asked = []
    monkeypatch.setattr(type(raw), "repartition", lambda df, *a: asked.append(a) or df)
    name = "spark.sql.files.minPartitionNum"
    with small_splits(spark, 3):
        assert spark.conf.get(name) == str(3 * spark.sparkContext.defaultParallelism)
    assert spark.conf.get(name, None) is None
    out = workflow.run(raw, spark.createDataFrame([("src-a", "iso8601")], "source_id string, raw_format string"))
    assert out.count() == 40 and asked == [] and spark.conf.get(name, None) is None
    spark.conf.set(name, "5")
    try:
        with pytest.raises(RuntimeError), small_splits(spark):
            raise RuntimeError
        assert spark.conf.get(name) == "5"
    finally:
        spark.conf.unset(name)
