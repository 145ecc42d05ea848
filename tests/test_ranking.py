"""Exact quantiles, ranks, tails and q values against plain Python, with one group that holds most rows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from obskit.operators import paired, ranking, screening


@pytest.fixture(scope="module")
def groups(spark):
    rng = random.Random(5)
    data = [("hot", "x", rng.choice([rng.lognormvariate(0, 2), 7.5, -rng.random(), 0.0])) for _ in range(2700)]
    data += [(f"g{i % 9}", None if i % 2 else "x", rng.choice([float(i % 4), -1e-9, 1e12, rng.gauss(0, 1)])) for i in range(290)] + [("lone", None, 3.0), ("none", "x", None)]
    return data, spark.createDataFrame(data, "a string, b string, v double")


def by_key(data):
    out = {}
    for a, b, v in data:
        if v is not None:
            out.setdefault((a, b), []).append(v)
    return out


def test_quantiles_of_any_group(groups):
    data, df = groups
    got = {(r.a, r.b): r for r in ranking.quantiles(df, ["a", "b"], "v", {"q10": 0.1, "median": 0.5, "top": 1.0}).collect()}
    want = by_key(data)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert (got[k].q10, got[k].median, got[k].top) == pytest.approx(tuple(np.percentile(v, [10, 50, 100])), rel=1e-12, abs=1e-15)
    whole = ranking.quantiles(df, [], "v", {"m": 0.5}).collect()
    assert [r.m for r in whole] == pytest.approx([np.median([v for *_, v in data if v is not None])])
    assert ranking.quantiles(df.limit(0), ["a"], "v", {"m": 0.5}).count() == 0


def test_mean_ranks_share_ties(groups):
    data, df = groups
    got = ranking.mean_ranks(df.filter("v is not null"), ["a", "b"], "v", "rank").collect()
    want = by_key(data)
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        v = want[(r.a, r.b)]
        assert r["rank"] == sum(x < r.v for x in v) + (sum(x == r.v for x in v) + 1) / 2


def test_no_task_window_holds_a_group(groups):
    """Windows over values are partitioned by bucket; the others see bucket counts."""
    plan = ranking.quantiles(groups[1], ["a", "b"], "v", {"m": 0.5})._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "collect" not in plan


def test_q_values(spark):
    rng = random.Random(2)
    p = [rng.choice([rng.random() ** 3, 0.5, 1e-30, 0.0]) for _ in range(300)]
    order = sorted(range(len(p)), key=lambda i: p[i])
    q, low = [0.0] * len(p), 1.0
    for rank in range(len(p), 0, -1):
        i = order[rank - 1]
        top = max(k + 1 for k in range(len(p)) if p[order[k]] == p[i])
        low = min(low, p[i] * len(p) / top)
        q[i] = low
    got = screening.benjamini_hochberg(spark.createDataFrame(list(enumerate(p)), "i int, p double"), "p").collect()
    assert [r.q_value for r in sorted(got)] == pytest.approx(q)


def test_hypergeometric_tail_is_exact(spark):
    cases = [(3, 50, 10, 12), (0, 50, 10, 12), (12, 50, 10, 12), (1, 20, 19, 5), (40, 5000, 300, 200), (8, 1_000_000, 50, 1000), (60, 1_000_000, 20_000, 900), (2300, 1_000_000, 20_000, 100_000), (10, 100, 50, 20), (9, 30, 10, 29), (1950, 1_000_000, 20_000, 100_000)]
    df = spark.createDataFrame(cases, "x bigint, n bigint, k bigint, m bigint")
    for r in screening.hypergeometric_survival(df, "x", "n", "k", "m").collect():
        low, high = max(0, r.m - (r.n - r.k)), min(r.m, r.k)
        if r.x <= low:
            want = 1.0
        elif r.x > high:
            want = 0.0
        else:  # whole numbers from the first term on, by the exact ratio of neighbours
            term = Fraction(math.comb(r.k, r.x) * math.comb(r.n - r.k, r.m - r.x), math.comb(r.n, r.m)) if r.n <= 5000 else None
            if term is None:
                lg = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
                terms = [math.exp(lg(r.k, i) + lg(r.n - r.k, r.m - i) - lg(r.n, r.m)) for i in range(r.x, high + 1)]
                want = math.fsum(terms)
            else:
                total = Fraction(0)
                for i in range(r.x, high + 1):
                    total += Fraction(math.comb(r.k, i) * math.comb(r.n - r.k, r.m - i), math.comb(r.n, r.m))
                want = float(total)
        assert r.p_value == pytest.approx(want, rel=1e-6), r


def test_resampled_medians_follow_the_values(spark):
    """Positions of a resample's median have the distribution that drawing the values gives."""
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 30):
        drawn = paired.resample_positions(n, 40_000, 9)
        plain = np.sort(rng.integers(0, n, (40_000, n)), axis=1)[:, [(n - 1) // 2, n // 2]]
        assert drawn.min() >= 0 and drawn.max() < n
        assert np.allclose(drawn.mean(axis=0), plain.mean(axis=0), atol=0.1) and np.allclose(drawn.std(axis=0), plain.std(axis=0), atol=0.1)
    df = spark.createDataFrame([("a", float(i)) for i in range(200)] + [("b", 5.0), ("b", None)], "k string, ratio double")
    got = {r.k: r for r in paired.bootstrap_median_ci(df, ["k"], n=500).collect()}
    assert got["a"].n == 200 and got["a"].median == 99.5 and 80 < got["a"].ci_low < 99.5 < got["a"].ci_high < 120
    assert (got["b"].median, got["b"].ci_low, got["b"].ci_high) == (5.0, 5.0, 5.0)
    again = {r.k: r for r in paired.bootstrap_median_ci(df.repartition(7), ["k"], n=500).collect()}
    assert got == again


def test_outlier_columns_of_the_same_name_stay_apart(spark):
    rows = [(f"r{i}", "As", "soil", "mg/kg", "reported", float(10 + i % 5) if i else 1e6, "mine", 1) for i in range(30)]
    obs = spark.createDataFrame(rows, "record_id string, element string, medium string, unit string, qualifier string, value double, log string, why int")
    got = screening.robust_anomalies(obs, ["element", "medium", "unit"]).collect()
    assert [r.record_id for r in got] == ["r0"] and got[0]["log"] == "mine" and got[0].why == 1 and got[0].direction == "high"
    assert screening.robust_anomalies(obs.limit(0), ["element", "medium", "unit"]).count() == 0


def test_normal_tail_and_tests_by_hand(spark):
    z = [0.0, 0.3, -1.96, 3.5, -6.0]
    got = spark.createDataFrame([(x,) for x in z], "z double").select("z", paired.normal_tail(F.col("z")).alias("p")).collect()
    assert [r.p for r in got] == pytest.approx([math.erfc(abs(x) / math.sqrt(2)) for x in z], rel=2e-7)
    rng = random.Random(6)
    rows = [("m", rng.choice(["a", "b"]), float(rng.randint(1, 12)), "reported") for _ in range(150)]
    r = paired.rank_sum_test(spark.createDataFrame(rows, "k string, side string, value double, qualifier string"), "side", "a", "b", ["k"]).collect()[0]
    a, b = ([v for _, s, v, _ in rows if s == x] for x in "ab")
    assert r.u == sum((x > y) + 0.5 * (x == y) for x in a for y in b) and (r.n_a, r.n_b) == (len(a), len(b)) and 0 < r.p_value <= 1
