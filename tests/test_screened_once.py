"""Rows are computed once for all scans of a screening, and cells are counted without ids."""

from pyspark.sql import functions as F

from obskit.operators import sampling, screening


def test_rows_are_computed_once(spark):
    rows = spark.createDataFrame([(f"r{i}", "a", "reported", 10.0 ** (5 if i == 7 else i % 7 / 10)) for i in range(200)], "record_id string, g string, qualifier string, value double")
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    found = screening.robust_anomalies(rows.mapInArrow(count, rows.schema), ["g"])
    assert [r.record_id for r in found.collect()] == ["r7"] and read.value == 200


def test_cells_meet_no_candidate_by_id(spark):
    rows = spark.createDataFrame([(f"r{i}", "soil", float(i % 2 * 50), 1.0) for i in range(400)] + [("x", "soil", None, None)], "record_id string, medium string, lon double, lat double")
    flagged = rows.filter((F.col("lon") == 50) & (F.substring("record_id", -1, 1) == "1") | (F.col("record_id") == "x")).withColumn("direction", F.lit("high"))
    out = screening.spatial_anomaly_cells(rows, flagged, ["medium"])
    assert [(r.n_cell, r.k_cell, r.n_group, r.k_group) for r in out.collect()] == [(200, 40, 400, 40)]
    cut = screening.spatial_anomaly_cells(rows.drop("record_id"), flagged.drop("record_id"), ["medium"])
    assert [(r.n_cell, r.k_cell) for r in cut.collect()] == [(200, 40)]


def test_batch_gate_shuffles_no_measurements(spark):
    decided = spark.range(1_000_000).groupBy(F.concat(F.lit("B"), (F.col("id") % 50).cast("string")).alias("batch_id")).agg(F.when(F.min("id") % 2 == 0, "pass").otherwise("fail").alias("status"))
    obs = spark.range(5_000_000).select("id", F.concat(F.lit("B"), (F.col("id") % 60).cast("string")).alias("batch_id"))
    out = screening.apply_batch_gate(obs, decided)
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    got = {r.batch_id: r.batch_status for r in out.filter("id < 60").collect()}
    assert (got["B0"], got["B1"], got["B55"]) == ("pass", "fail", "incomplete")


def test_review_sample_places_rows_once(spark):
    rows = spark.createDataFrame([(f"r{i:03d}", i, f"m{i % 3}", "a", float(i)) for i in range(100)], "id string, n long, medium string, g string, value double")
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    out = sampling.review_sample(rows.mapInArrow(count, rows.schema), 10, ["n", "id"], ["medium"], "g", "value").collect()
    assert len(out) == 10 and {r.id for r in out} >= {"r000", "r001", "r002", "r024", "r049", "r074", "r099"}
    assert read.value <= 200
