"""Medians and deviations in brackets against plain sorting, on hot groups, ties, offsets and huge spreads."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from obskit.operators import bracket, screening


def groups(seed):
    rng = random.Random(seed)
    return {
        "hot": [rng.lognormvariate(0, 2) for _ in range(40_000)],
        "offset": [1.7e9 + rng.random() for _ in range(5_000)],
        "years": [1990 + rng.randint(0, 36) + rng.randint(0, 11) / 12 for _ in range(5_000)],
        "ties": [rng.choice([1.0, 1.0, 1.0, 2.0, 3.0]) for _ in range(3_000)],
        "constant": [5.5] * 500,
        "two humps": [rng.gauss(rng.choice([-1e6, 1e6]), 1) for _ in range(4_001)],
        "wide": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(2_000)],
        "one": [3.25], "two": [1.0, 4.0], "three": [1.0, 2.0, 100.0],
        None: [rng.gauss(0, 1) for _ in range(999)],
        **{f"small {i}": [rng.choice([rng.random(), float(rng.randint(0, 3))]) for _ in range(i % 9 + 1)] for i in range(40)},
    }


@pytest.mark.parametrize("few", [5_000_000, 0])
def test_medians_and_deviations_are_exact(spark, few):
    for seed in (1, 2):
        data = groups(seed)
        rows = [(g, v, 0) for g, vs in data.items() for v in vs] + [("nothing", None, 0), ("hot", None, 0)]
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "`key 0` string, v double, median int").repartition(7)
        seen = df.groupBy("key 0").agg(F.count("v").alias("n"), bracket.summary(F.col("v")).alias("p")).withColumn("bracket", bracket.brackets(F.col("p")))
        got = {r["key 0"]: (r["median"], r["mad"]) for r in bracket.median_and_deviation(df, seen, ["key 0"], "v", few).collect()}
        assert set(got) == set(data)
        for g, vs in data.items():
            m = statistics.median(vs)
            assert got[g][0] == pytest.approx(m, rel=1e-12, abs=0) and got[g][1] == pytest.approx(statistics.median(abs(v - got[g][0]) for v in vs), rel=1e-12, abs=0), g


def test_a_wrong_bracket_fails_instead_of_answering(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(100)], "g string, v double")
    wrong = df.groupBy("g").agg(F.count("v").alias("n")).withColumn("bracket", F.struct(F.lit(70.0).alias("lo"), F.lit(80.0).alias("hi"), F.lit(0.0).alias("near"), F.lit(1.0).alias("far")))
    with pytest.raises(Exception, match="outside its bracket"):
        bracket.median_and_deviation(df, wrong, ["g"], "v").collect()


def test_second_scan_keeps_about_a_hundredth(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.gauss(0, 1),) for _ in range(100_000)], "v double")
    b = df.agg(bracket.brackets(bracket.summary(F.col("v"))).alias("b")).first().b
    xs = [r.v for r in df.collect()]
    kept = sum(b.lo <= v <= b.hi or not (v < b.lo + b.near and v > b.hi - b.near) and b.lo - b.far <= v <= b.hi + b.far for v in xs)
    assert kept < 2_500


def test_rows_are_shuffled_by_no_scan(spark, tmp_path):
    """The report of a hot group: the rows of the table meet no exchange before they are aggregated."""
    path = str(tmp_path / "t")
    spark.range(20_000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 70).cast("string"))).alias("g"), F.exp(F.randn(1)).alias("value"), F.lit("reported").alias("qualifier")).write.parquet(path)
    found = screening.robust_anomalies(spark.read.parquet(path), ["g"], z=2.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert found.count() > 0


def test_screening_leaves_nothing_cached_and_stands_clashing_names(spark):
    rows = [("a", float(i % 17 + 1), "reported", i) for i in range(200)] + [("a", 1e9, "reported", 999), ("a", float("nan"), "reported", 1000)]
    df = spark.createDataFrame(rows, "g string, value double, qualifier string, `key 0` int").withColumns({c: F.lit(1) for c in ("log", "why", "z", "row", "v", "n", "k", "bracket", "points", "median", "mad", "_s", "direction")})
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    hit = screening.robust_anomalies(df, ["g"])
    assert [c for c in hit.columns if c not in ("robust_z", "direction")] == [c for c in df.columns if c != "direction"]
    assert [r["key 0"] for r in hit.collect()] == [999]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
