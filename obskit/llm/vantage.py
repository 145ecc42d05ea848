"""Centroid clustering: Lloyd rounds over integer vectors, each vector led to its centroid by a vantage-point tree.

Only the centroids (k rows) are on the driver. A round builds the tree over them, broadcasts it, and searches it for
every vector, best first: a subtree is opened while the least distance it can hold is not above the best one found,
the bound included, so that equal distances are compared and the smaller number wins. Each task sends exact sums of
its clusters, k rows; Spark adds them.

Defined cases: vectors of another length than ``dims``, null ones and those with a null or non-finite component take
no part; a null id counts as the text "null" in the choice of first centroids and is clustered like others; repeated
rows count each; fewer vectors than ``k`` give as many centroids; an empty table gives no rows; other columns are carried in ``row``, so no
name clashes. Sums and distances are exact at any size; ``distance`` and the inertias are null where no long holds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, forget, row_type
from .vectors import distances, finite, longs, root_above, root_below, rows_of, whole

#: A sum is sent in parts of so many bits, which Spark can add without overflow.
PART = 32


@dataclass
class Node:
    """A leaf has ``members`` only; an inner node has one member, its vantage point, and (child, least, largest distance from it)."""

    members: np.ndarray
    children: list[tuple[int, object, object]]


class VantageTree:
    """Nearest centroid by branch and bound; of equally near ones that with the smallest number."""

    def __init__(self, centroids: np.ndarray, leaf: int = 4):
        self.centroids, self.nodes = centroids, []
        if len(centroids):
            self._build(np.arange(len(centroids)), distances(centroids, centroids), leaf)

    def _build(self, members: np.ndarray, apart: np.ndarray, leaf: int) -> int:
        at = len(self.nodes)
        self.nodes.append(Node(members, []))
        if len(members) > leaf:
            near = root_below(apart[np.ix_(members, members)]).astype(np.float64)
            vantage = members[near.var(axis=1).argmax()]  # the one whose distances spread most
            rest = members[members != vantage]
            rest = rest[np.argsort(apart[vantage, rest], kind="stable")]
            self.nodes[at].members = np.array([vantage])
            for half in (rest[: len(rest) // 2], rest[len(rest) // 2 :]):
                lo, hi = root_below(apart[vantage, half[:1]])[0], root_above(apart[vantage, half[-1:]])[0]
                self.nodes[at].children.append((self._build(np.sort(half), apart, leaf), lo, hi))
        return at

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of every row of ``x``.

        Each row has its own queue of subtrees and opens the most promising one in every step; rows that open the
        same subtree share one exact product.
        """
        n = len(x)
        wide = x.dtype == object or self.centroids.dtype == object
        best, squared = np.full(n, -1), np.zeros(n, dtype=object if wide else np.int64)
        reach = np.full(n, np.inf, dtype=object if wide else np.float64)
        bound = np.full((n, len(self.nodes)), np.inf, dtype=reach.dtype)
        bound[:, 0] = 0
        rows = np.arange(n)
        while len(rows):
            node = bound[rows].argmin(axis=1)
            low = bound[rows, node]
            open_ = (low <= reach[rows]) & (low < np.inf)
            rows, node = rows[open_], node[open_]
            for j in np.unique(node).tolist():
                self._visit(x, j, rows[node == j], bound, best, squared, reach)
        return best, squared

    def _visit(self, x, j, rows, bound, best, squared, reach) -> None:
        node = self.nodes[j]
        here = bound[rows, j]
        bound[rows, j] = np.inf
        found = distances(x[rows], self.centroids[node.members]).astype(squared.dtype)
        first = found.argmin(axis=1)  # members ascend: the smallest number of the nearest ones
        d, c = found[np.arange(len(rows)), first], node.members[first]
        better = (best[rows] < 0) | (d < squared[rows]) | ((d == squared[rows]) & (c < best[rows]))
        took = rows[better]
        best[took], squared[took], reach[took] = c[better], d[better], root_above(d[better])
        if node.children:
            above, below = root_above(found[:, 0]), root_below(found[:, 0])
            for child, lo, hi in node.children:
                bound[rows, child] = np.maximum(here, np.maximum(below - hi, lo - above))


def _tree_rows(batches: Iterator[pa.RecordBatch], tree: VantageTree, dims: int, most: int = 4096) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for b in batches:
        for at in range(0, b.num_rows, most):
            part = b.slice(at, most)
            x = rows_of(part.column("vector"), dims)
            yield part, x, *tree.nearest(x)


def _parts(sums: np.ndarray, parts: int) -> np.ndarray:
    """Each number as ``parts`` numbers that are small but for the last: their sum, shifted, is the number."""
    cut = [(sums >> (PART * i)) & ((1 << PART) - 1) for i in range(parts - 1)]
    return np.concatenate([*cut, sums >> (PART * (parts - 1))], axis=-1).astype(np.int64)


def _moved(kept: DataFrame, centroids: np.ndarray, parts: int) -> np.ndarray:
    """The centroids after one round: componentwise floor(sum / count) of their vectors, or themselves if they have none."""
    k, dims = centroids.shape
    shared = kept.sparkSession.sparkContext.broadcast(VantageTree(centroids))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), dtype=np.int64 if parts == 1 else object), np.zeros(k, dtype=np.int64)
        for _, x, cluster, _ in _tree_rows(batches, shared.value, dims):
            np.add.at(sums, cluster, x)
            counts += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(counts)
        out = _parts(sums[some], parts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some], pa.int64()), pa.array(out.tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    sent = kept.select("vector").mapInArrow(each, "cluster int, n bigint, sums array<bigint>")
    exact = "decimal(38,0)"
    by_place = sent.select("cluster", "n", F.posexplode("sums")).groupBy("cluster", "pos").agg(F.sum(F.col("col").cast(exact)).alias("s"), F.sum("n").alias("n"))
    moved = centroids.astype(object)
    totals = np.zeros((k, dims * parts), dtype=object)
    counts = [0] * k
    for r in by_place.collect():
        totals[r.cluster, r.pos], counts[r.cluster] = int(r.s), r.n
    shared.unpersist()
    for c in range(k):
        if counts[c]:
            moved[c] = [sum(totals[c, i + j * dims] << (PART * j) for j in range(parts)) // counts[c] for i in range(dims)]
    return moved if parts > 1 else moved.astype(np.int64)


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, id: str = "vec_id", vector: str = "embedding", seed: int = 2, keep: list[str] | None = None) -> DataFrame:
    """(row, cluster, distance, cluster_inertia, inertia, centroid): ``keep`` (all columns, if None) as a struct, the
    centroid's number, squared distance and components, and squared distances summed over the cluster and over all.

    The first centroids are the ``k`` kept vectors with the smallest SHA-256 of ``seed:id``, equal ids by vector.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    row = F.struct(*[F.col(f"`{c}`") for c in (rows.columns if keep is None else keep)])
    kept = durable(rows.filter(finite(v) & (F.size(v) == dims)).select(row.alias("row"), v.alias("vector"), F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("null")).alias("id")))
    first = kept.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), "id"), 256), "vector").limit(k).select("vector").collect()
    top = kept.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0] or 0.0
    parts = 1 if top < 2.0**18 else (int(top) * 256).bit_length() // PART + 2
    centroids = whole(np.array([r.vector for r in first], dtype=np.float64).reshape(len(first), dims))
    centroids = centroids if parts == 1 else centroids.astype(object)
    for _ in range(rounds if first else 0):
        before, centroids = centroids, _moved(kept, centroids, parts)
        if (before == centroids).all():
            break
    shared = kept.sparkSession.sparkContext.broadcast(VantageTree(centroids))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, number, squared in _tree_rows(batches, shared.value, dims):
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(number, pa.int32()), longs(squared)], names=["row", "cluster", "distance"])

    placed = durable(kept.select("row", "vector").mapInArrow(each, f"{row_type(kept)}, cluster int, distance bigint"))
    forget(kept)
    # A sum is null as soon as one of its distances is.
    total = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {r.cluster: r.total for r in placed.groupBy("cluster").agg(total.alias("total")).collect()}
    fits = lambda v: int(v) if v is not None and v < 2**63 else None
    inertia = fits(None if None in sums.values() else sum(sums.values()))
    stats = [(c, fits(s), inertia, [str(x) for x in centroids[c].tolist()]) for c, s in sums.items()]
    found = kept.sparkSession.createDataFrame(stats, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<string>")
    return placed.join(F.broadcast(found), "cluster").select("row", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
