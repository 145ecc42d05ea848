"""Centroid clustering and hard-negative mining against brute force in Python integers, and their defined cases."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from obskit.llm import gnat, vantage, vectors

ROWS = "vec_id bigint, embedding array<float>, label int"


def whole(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def random_rows(seed, n, dims, spread=1.0, step=1 / 64):
    """Coarse components, so that distances and scores tie; some clusters, some copies."""
    rng = random.Random(seed)
    homes = [[rng.uniform(-spread, spread) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        home = rng.choice(homes)
        rows.append((i, [round((h + rng.gauss(0, 0.2)) / step) * step for h in home], rng.randint(0, 3)))
    return rows


def odd_rows(dims):
    nan, inf = float("nan"), float("inf")
    return [(900, None, 1), (901, [nan] * dims, 1), (902, [inf] + [0.0] * (dims - 1), 0), (903, [None] * dims, 0), (904, [0.5] * (dims - 1), 2), (905, [], 1), (None, [0.25] * dims, 1), (700, [0.5] * dims, None)]


# ---------------------------------------------------------------- clustering


def brute_clusters(rows, k, rounds, dims):
    kept = [(i, v, whole(v)) for i, v, _ in rows if sound(v) and len(v) == dims]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(r[2]) for r in order[:k]]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        to = [near(q)[1] for _, _, q in kept]
        for j in range(len(centroids)):
            mine = [q for (_, _, q), t in zip(kept, to) if t == j]
            if mine:
                centroids[j] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [(i, *near(q)) for i, _, q in kept]
    sums = {}
    for _, d, c in found:
        sums[c] = sums.get(c, 0) + d
    return sorted([(str(i), c, d, sums[c], sum(sums.values()), [str(x) for x in centroids[c]]) for i, d, c in found])


@pytest.mark.parametrize("k, rounds", [(7, 3), (40, 5)])
def test_clusters_match_brute_force(spark, k, rounds):
    dims = 6
    rows = random_rows(k, 150, dims) + odd_rows(dims) + random_rows(k, 5, dims) * 2
    df = spark.createDataFrame(rows, ROWS).repartition(3).withColumns({"cluster": F.lit("x"), "row": F.lit(1), "vector": F.lit(2), "id": F.lit(3)})
    got = vantage.cluster(df, k, rounds, dims)
    assert got.schema["row"].dataType.names == df.columns
    mine = sorted((str(r.row.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in got.collect())
    assert mine == brute_clusters(rows, k, rounds, dims)


def test_clusters_of_huge_components_and_empty_tables(spark):
    rows = [(i, [s * 3.0e38, 1.0e30 * i, 0.0], 0) for i in range(12) for s in (1, -1)] + [(50 + i, [float(i), 1e6, -1e6], 0) for i in range(6)]
    got = vantage.cluster(spark.createDataFrame(rows, ROWS), 3, 4, 3).collect()
    want = brute_clusters(rows, 3, 4, 3)
    fits = lambda v: v if v < 2**63 else None
    assert sorted((str(r.row.vec_id), r.cluster, r.centroid) for r in got) == sorted((i, c, cs) for i, c, _, _, _, cs in want)
    assert sorted((r.row.vec_id, str(r.distance), str(r.inertia)) for r in got) == sorted((int(i), str(fits(d)), str(fits(s))) for i, _, d, _, s, _ in want)
    assert vantage.cluster(spark.createDataFrame([], ROWS), 3, 2, 3).count() == 0
    assert vantage.cluster(spark.createDataFrame([(1, [1.0], 0)], ROWS), 3, 2, 3).count() == 0


def test_tree_search_opens_few_nodes_where_centroids_are_apart_and_keeps_ties():
    rng = np.random.default_rng(3)
    centroids = rng.integers(-100_000, 100_000, (40, 3))
    centroids[7] = centroids[31]  # a tie: number 7 wins
    tree, opened = vantage.VantageTree(centroids), []
    visit = tree._visit
    tree._visit = lambda x, j, rows, *rest: (opened.append(len(rows)), visit(x, j, rows, *rest))
    x = np.concatenate([centroids + rng.integers(-50, 50, centroids.shape), centroids])
    number, d = tree.nearest(x)
    all_d = vectors.distances(x, centroids)
    assert (number == all_d.argmin(axis=1)).all() and (d == all_d.min(axis=1)).all() and 31 not in number
    assert sum(opened) < 0.7 * len(x) * len(tree.nodes)


def test_integer_arithmetic_is_exact_at_every_size():
    for top in (10, 2**25, 2**40, 2**90):
        rng = random.Random(top)
        a = np.array([[rng.randint(-top, top) for _ in range(5)] for _ in range(4)], dtype=object)
        b = np.array([[rng.randint(-top, top) for _ in range(5)] for _ in range(3)], dtype=object)
        d = vectors.distances(a, b)
        assert d.tolist() == [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, q)) for q in b] for p in a]
        assert vectors.products(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
        assert all(lo**2 <= v <= hi**2 for lo, v, hi in zip(vectors.root_below(d).ravel().tolist(), d.ravel().tolist(), vectors.root_above(d).ravel().tolist()))
    assert vectors.whole(np.array([-0.001, 0.999, 1e300])).tolist() == [-1, 255, int(1e300) * 256]
    assert vectors.rows_of(pa.array([[1.0], [], [1.0, 2.0]])).tolist() == [[256, 0], [0, 0], [256, 512]]


# ---------------------------------------------------------------- hard negatives


def brute_negatives(rows, anchor, positives=5, negatives=10):
    kept = [(i, whole(v), label) for i, v, label in rows if label is not None and sound(v)]
    dot = lambda p, q: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(p, q))))
    order = lambda hit: (-hit[0], hit[1] is None, hit[1] or 0)
    out = []
    for k, (i, v, label) in enumerate(kept):
        if i is None or not anchor(i):
            continue
        scored = [(dot(v, w), j, other) for m, (j, w, other) in enumerate(kept) if m != k]
        for ps, pid, _ in sorted((s for s in scored if s[2] == label), key=order)[:positives]:
            fits = sorted((s for s in scored if s[2] != label and 30 * ps <= 100 * s[0] <= 90 * ps), key=order)[:negatives]
            out += [(i, pid, rank, nid, ps, ns) for rank, (ns, nid, _) in enumerate(fits, 1)]
    return sorted(map(str, out))


@pytest.mark.parametrize("block_rows", [4096, 64])
def test_negatives_match_brute_force(spark, block_rows):
    dims = 4
    rows = random_rows(1, 400, dims) + odd_rows(dims) + [(20, [0.5] * dims, 1)] * 9 + [(21, [0.5] * dims, 2)] * 14 + [(20, [0.25] * dims, 1), (30, [0.0] * dims, 0)]
    df = spark.createDataFrame(rows, ROWS).withColumns({"id": F.lit("x"), "cell": F.lit(0), "n": F.lit(0), "vector": F.lit(0)})
    got = gnat.mine(df, F.col("id") % 10 == 0, ways=5, block_rows=block_rows)
    assert sorted(str(tuple(r)) for r in got.collect()) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_of_huge_components_and_empty_tables(spark):
    rows = [(i, [3.0e38 * (-1) ** i, float(i)], i % 2) for i in range(12)] + [(20 + i, [1.0e5, float(i)], i % 3) for i in range(12)]
    got = gnat.mine(spark.createDataFrame(rows, ROWS), F.col("id") % 5 == 0)
    assert sorted(str(tuple(r)) for r in got.collect()) == brute_negatives(rows, lambda i: i % 5 == 0)
    assert gnat.mine(spark.createDataFrame([], ROWS), F.col("id") % 5 == 0).count() == 0
    assert gnat.mine(spark.createDataFrame([(5, [1.0], 1)], ROWS), F.col("id") % 5 == 0).count() == 0


def test_ranges_leave_out_siblings_but_no_answer():
    rng = np.random.default_rng(5)
    homes = rng.integers(-3000, 3000, (30, 3))
    x = (homes[rng.integers(0, 30, 3000)] + rng.integers(-60, 60, (3000, 3))).astype(np.int64)
    tree = gnat.Tree(x, np.arange(3000), np.ones(3000, bool), np.array(["a"] * 3000), np.ones(3000, np.int64))
    q = x[:20]
    score = vectors.products(q, x)
    hi = np.sort(score, axis=1)[:, [-200, -20]].astype(np.int64)
    lo = hi - 20_000
    asked = gnat.Queries(q, np.array(["a"] * 20), lo, hi, True)
    looked = []
    offer = tree._offer
    tree._offer = lambda rows, who, *rest: (looked.append(len(rows) * len(who)), offer(rows, who, *rest))
    tree.search(asked, 8)
    for w in range(2):
        best = {k: [] for k in range(20)}
        for k, s, i in zip(asked.best[w][0].tolist(), asked.best[w][1].tolist(), asked.best[w][2].tolist()):
            best[k].append((-s, i))
        for k in range(20):
            want = sorted((-int(s), i) for i, s in enumerate(score[k]) if lo[k, w] <= s <= hi[k, w])[:8]
            assert best[k] == want
    assert sum(looked) < 0.5 * 20 * 3000, "most leaves are never read"
