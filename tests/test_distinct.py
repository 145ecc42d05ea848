"""Distinct counts as sums against sets, at every level, with nulls, hot values and clashing names."""

import random

from pyspark.sql import functions as F

from obskit.operators import distinct, reports

KEYS = ("source_id", "medium", "element")


def table(spark, seed, n=3000):
    rng = random.Random(seed)
    pick = lambda *xs: rng.choice([*xs, None])
    rows = []
    for i in range(n):
        hot = rng.random() < 0.4
        rows.append((pick("a", "b"), pick("soil", "water"), pick("As", "Pb", "Zn"), "hot" if hot else pick(*[f"s{k}" for k in range(200)]), pick("l1", "l2"), None if rng.random() < 0.3 else rng.uniform(-180, 180), rng.uniform(-90, 90), pick(1.0)))
    return rows, spark.createDataFrame(rows, "source_id string, medium string, element string, sample_id string, lineage string, lon double, lat double, value double").repartition(5)


def cell(r):
    return None if r[5] is None else (min(359, int((r[5] + 180) // 1)), min(179, int((r[6] + 90) // 1)))


def test_roll_up_equals_sets(spark):
    rows, df = table(spark, 1)
    own = df.withColumns({"key 0": F.lit(1), "cell": F.lit("x"), "bits": F.lit(2), "level": F.lit(3)})
    got = sorted((tuple(r) for r in reports.coverage_cube(own, KEYS, totals=True).collect()), key=str)
    want = []
    for n in range(4):
        groups = {}
        for r in rows:
            groups.setdefault(r[:n], []).append(r)
        for k, rs in groups.items():
            size = lambda f, rs=rs: len({f(r) for r in rs} - {None})
            located = len({r[3] for r in rs if r[5] is not None} - {None})
            want.append((n, *k, *[None] * (3 - n), len(rs), size(lambda r: r[3]), located, sum(r[7] is not None for r in rs), size(lambda r: r[4]), size(cell)))
    assert got == sorted([w[1:] for w in want], key=str)
    finest = sorted((tuple(r) for r in reports.coverage_cube(df, KEYS).collect()), key=str)
    assert finest == sorted([w[1:] for w in want if w[0] == 3], key=str)
    assert reports.coverage_cube(df.limit(0), KEYS, totals=True).count() <= 1


def test_rows_carry_one_number_each(spark):
    df = spark.createDataFrame([("x", "a", "b"), ("x", "a", "b"), ("x", "a", "c"), ("x", "d", None), ("y", None, None)], "s string, p string, q string")
    got = sorted((tuple(r) for r in df.select("s", "p", "q", distinct.first_level("s", ["p", "q"]).alias("n")).collect()), key=str)
    assert got == sorted([("x", "a", "b", 0), ("x", "a", "b", None), ("x", "a", "c", 2), ("x", "d", None, 1), ("y", None, None, 0)], key=str)


def test_no_row_is_multiplied_for_a_level(spark):
    _, df = table(spark, 2, 300)
    plan = reports.coverage_cube(df, KEYS, totals=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.index("Expand") < plan.index("Window"), "only the few rows by all keys are rolled up"


def test_views_and_balance_equal_sets(spark):
    rows, df = table(spark, 3)
    df = df.withColumns({"domain": F.lit("land"), "macroregion": F.lit(None).cast("string"), "country": F.col("medium"), "license": F.lit("l"), "url": F.lit("https://x"), "doi": F.lit("d")})
    got = {(r.view, r.key): (r.records, r.samples) for r in reports.database_coverage(df).collect()}
    for view, i in (("source", 0), ("medium", 1), ("element", 2), ("lineage", 4), ("country", 1)):
        for k in {r[i] for r in rows} - {None}:
            mine = [r for r in rows if r[i] == k]
            assert got[view, k] == (len(mine), len({r[3] for r in mine} - {None}))
    assert got["total", "all"] == (len(rows), len({r[3] for r in rows} - {None})) and not any(v == "macroregion" for v, _ in got)
    balance = {(r.medium, r.element): (r.records, r.lineages, r.sources, r.cells) for r in reports.medium_balance(df).collect() if r.element}
    for (m, e), v in balance.items():
        mine = [r for r in rows if r[1] == m and r[2] == e]
        assert v == (len(mine), len({r[4] for r in mine} - {None}), len({r[0] for r in mine} - {None}), len({cell(r) for r in mine} - {None}))


def test_views_are_not_multiplied_by_samples(spark):
    _, df = table(spark, 4, 300)
    df = df.withColumns({"domain": F.lit("land"), "macroregion": F.lit("m"), "country": F.col("medium"), "license": F.lit("l"), "url": F.lit("https://x"), "doi": F.lit("d")})
    plan = reports.database_coverage(df)._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.split("\n") if "Aggregate [" in line]
    assert "Generate" in plan and not any("view" in g and "sample_id" in g for g in grouped), "multiplied rows are added up by view and key alone"


def test_cohorts_count_samples_across_sources(spark):
    rows = [("As", "s1", "a", 1.0), ("As", "s1", "b", None), ("As", "s2", "b", 2.0), ("As", None, "b", 3.0), ("Pb", "s1", "a", None)]
    df = spark.createDataFrame(rows, "element string, sample_id string, source_id string, value double").withColumns({c: F.lit(None).cast("string") for c in ("sampled_at", "band")}).withColumns({"qualifier": F.lit("reported"), "lon": F.lit(0.0), "lat": F.lit(0.0)})
    got = {r.element: (r.quantified, r.samples, r.quantified_samples, r.sources, r.top_source) for r in reports.analysis_cohorts(df, ["element"]).collect()}
    assert got == {"As": (3, 2, 2, 2, "b"), "Pb": (0, 1, 0, 1, "a")}


def test_rows_are_added_up_once_for_all_counts(spark):
    _, df = table(spark, 5, 300)
    more = df.withColumns({c: F.lit(None).cast("string") for c in ("sampled_at", "band")}).withColumn("qualifier", F.lit("reported"))
    for out in (reports.coverage_cube(df, KEYS, totals=True), reports.analysis_cohorts(more, ["element"])):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "parquet" in plan and "LogicalRDD" not in plan, "no count reads the rows anew"
