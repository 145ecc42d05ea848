"""Hard-negative mining: inner-product windows searched in multiway trees that know how far siblings lie.

A node of a tree has a few split points; each row goes to its nearest one (ties: the first). For every split point the
node stores the least and largest distance to the rows of each sibling, and for every sibling its least and largest
norm. A window [lo, hi] of inner products with a query, together with these norms, is an annulus around the query: rows
of a sibling outside it cannot answer. By the triangle inequality a sibling goes if, for any split point, its distance
range does not meet the annulus seen from there. Leaves compute exact integer products.

The root is Spark's: its split points come from a bounded sample, rows are dealt to (cell, block) where a block holds
about ``block_rows`` distinct rows, however large a cell, and each block becomes a tree of its own, written to the shared
folder. Queries visit only the blocks of cells that their windows meet. Three searches share the trees: an anchor's
positives in its own cell, then in cells that may hold better ones, then its negatives in their windows.

Defined cases: rows with a null label, a null vector or any null or non-finite component take no part; rows equal in
id, label and vector are kept once with their number and count each in all results; the shorter of two vectors counts
as filled up with 0; null ids come last among ties and are no anchors; an anchor without positives, and a positive of a negative score or
without rows in its window, has no rows; other columns are not read. Scores beyond a
long count as the nearest one.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import durable, forget
from .vectors import distances, finite, products, root_above, root_below, rows_of, squares, widen

#: Scores are kept within these, so that 100 times one still compares exactly as a decimal.
LEAST, MOST = -(2**63), 2**63 - 1


def spread_points(x: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` rows of ``x``, each the farthest from those before it."""
    if not len(x):
        return x
    chosen, near = [0], distances(x, x[:1])[:, 0]
    while len(chosen) < count and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


@dataclass
class Ranges:
    """Split points of a node, and for every child (column) its distances from each point (row) and its squared norms."""

    points: np.ndarray
    least: np.ndarray
    largest: np.ndarray
    norm_least: np.ndarray
    norm_largest: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, apart: np.ndarray, norms: np.ndarray, child: np.ndarray) -> Ranges:
        below, above, m = root_below(apart), root_above(apart), len(points)
        members = [child == j for j in range(m)]
        gather = lambda values, f: np.stack([f(values[rows]) for rows in members], axis=-1)
        return cls(points, gather(below, lambda v: v.min(axis=0)), gather(above, lambda v: v.max(axis=0)), gather(norms, np.min), gather(norms, np.max))

    def meet(self, x: np.ndarray, norms: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """(queries, children): may the child hold a row whose product with the query lies within [lo, hi]?

        Bounds are compared as floats with room for their rounding, so a child is only left out when it surely holds none.
        """
        width = max(x.shape[1], self.points.shape[1])
        d = distances(widen(x, width), widen(self.points, width))
        below, above = root_below(d).astype(np.float64)[:, :, None], root_above(d).astype(np.float64)[:, :, None]
        n = norms.astype(np.float64)[:, None]
        lo, hi = np.where(lo == LEAST, -np.inf, lo.astype(np.float64))[:, None], np.where(hi == MOST, np.inf, hi.astype(np.float64))[:, None]
        room = 1e-9 * (n + self.norm_largest.astype(np.float64) + np.abs(np.where(np.isfinite(lo), lo, 0)) + np.abs(np.where(np.isfinite(hi), hi, 0))) + 1e-6
        inner = np.sqrt(np.maximum(n + self.norm_least.astype(np.float64) - 2 * hi - room, 0))[:, None, :]
        outer = n + self.norm_largest.astype(np.float64) - 2 * lo + room
        far = np.sqrt(np.maximum(outer, 0))[:, None, :]
        least, largest = self.least.astype(np.float64)[None] * (1 - 1e-9), self.largest.astype(np.float64)[None] * (1 + 1e-9)
        out = (below - largest > far) | (least - above > far) | (above + largest < inner)
        return (outer >= 0) & ~out.any(axis=1) & (lo <= hi)


@dataclass
class Tree:
    """One block: rows with their ids (``has_id`` false: null), labels and numbers of equal rows."""

    x: np.ndarray
    ids: np.ndarray
    has_id: np.ndarray
    labels: np.ndarray
    counts: np.ndarray
    ways: int = 8
    leaf: int = 64
    nodes: list[tuple[Ranges, list]] = field(default_factory=list)

    def __post_init__(self):
        self.norms = squares(self.x)
        self.root = self._build(np.arange(len(self.x)))

    def _build(self, rows: np.ndarray):
        """A leaf is an array of row numbers, an inner node a number in ``nodes``."""
        if len(rows) <= self.leaf:
            return rows
        points = spread_points(self.x[rows[:: max(1, len(rows) // (8 * self.ways))]], self.ways)
        if len(points) < 2:
            points = spread_points(self.x[rows], self.ways)
        if len(points) < 2:
            return rows  # all alike
        apart = distances(self.x[rows], points)
        nearest = apart.argmin(axis=1)
        used, child = np.unique(nearest, return_inverse=True)
        at = len(self.nodes)
        self.nodes.append(())
        ranges = Ranges.of(points[used], apart[:, used], self.norms[rows], child)
        self.nodes[at] = (ranges, [self._build(rows[child == j]) for j in range(len(used))])
        return at

    def search(self, queries: Queries, most: int) -> None:
        """Offer every row that lies in a window to ``queries``, leaving out subtrees that cannot hold any."""
        stack = [(self.root, np.arange(len(queries.x)))]
        while stack:
            node, asked = stack.pop()
            if isinstance(node, np.ndarray):
                for at in range(0, len(node), 1024):
                    self._offer(node[at : at + 1024], asked, queries, most)
                continue
            ranges, children = self.nodes[node]
            lo, hi = queries.hull(asked)
            meets = ranges.meet(queries.x[asked], queries.norms[asked], lo, hi)
            for j in np.argsort(meets.sum(axis=0)).tolist():
                if meets[:, j].any():
                    stack.append((children[j], asked[meets[:, j]]))

    def _offer(self, rows: np.ndarray, asked: np.ndarray, queries: Queries, most: int) -> None:
        width = max(queries.x.shape[1], self.x.shape[1])
        score = products(widen(queries.x[asked], width), widen(self.x[rows], width))
        if score.dtype == object:
            score = np.clip(score, LEAST, MOST).astype(np.int64)
        alike = queries.labels[asked][:, None] == self.labels[rows]
        for w in range(queries.lo.shape[1]):
            fits = (alike == queries.same) & (score >= queries.lo[asked, w][:, None]) & (score <= queries.hi[asked, w][:, None]) & (score >= queries.least[asked, w][:, None])
            q, r = np.nonzero(fits)
            if len(q):
                queries.take(asked[q], w, score[q, r], self.ids[rows[r]], self.has_id[rows[r]], self.counts[rows[r]], most)


class Queries:
    """Queries of one task, each with windows [lo, hi] of scores, and the best rows found for every window."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, lo: np.ndarray, hi: np.ndarray, same: bool):
        self.x, self.labels, self.lo, self.hi, self.same = x, labels, lo, hi, same
        self.norms = squares(x)
        self.least = np.full(lo.shape, LEAST, dtype=np.int64)
        none = np.zeros(0, dtype=np.int64)
        self.best = [(none, none, none, none.astype(bool), none) for _ in range(lo.shape[1])]

    def hull(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and largest score that any window of a query still wants; empty windows want none."""
        lo, hi = np.maximum(self.lo[asked], self.least[asked]), self.hi[asked]
        wanted = lo <= hi
        return np.where(wanted, lo, MOST).min(axis=1), np.where(wanted, hi, LEAST).max(axis=1)

    def take(self, q, w, score, ids, has_id, counts, most: int) -> None:
        q, score, ids, has_id, counts = (np.concatenate(p) for p in zip(self.best[w], (q, score, ids, has_id, counts)))
        order = np.lexsort((ids, ~has_id, ~score, q))  # ~ turns the order around and cannot overflow
        q, score, ids, has_id, counts = (v[order] for v in (q, score, ids, has_id, counts))
        first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        full = rank == most - 1
        self.least[q[full], w] = score[full]
        keep = rank < most
        self.best[w] = tuple(v[keep] for v in (q, score, ids, has_id, counts))


# ---------------------------------------------------------------- on Spark


@dataclass
class Index:
    """Trees (cell, block, tree) in the shared folder, the distinct rows they hold, and what the driver knows of the root."""

    trees: DataFrame
    rows: DataFrame
    root: Ranges
    cells: list[int]
    blocks: dict[int, int]


def build_index(rows: DataFrame, ways: int = 16, sample: int = 512, block_rows: int = 4096) -> Index:
    """Index ``rows`` (id bigint, label, vector). The root's ``ways`` split points come from the ``sample`` rows with the
    smallest hashes; every row is indexed. ``block_rows`` holds for up to 128 components, longer vectors make smaller blocks."""
    spark = rows.sparkSession
    sound = rows.filter(F.col("label").isNotNull() & finite(F.col("vector"))).select("id", "label", F.col("vector").cast("array<double>").alias("vector"))
    seen = [r.vector for r in sound.select("vector", F.xxhash64("vector").alias("h")).orderBy("h", "vector").limit(sample).collect()]
    points = spark.sparkContext.broadcast(spread_points(rows_of(pa.array(seen, pa.list_(pa.float64()))), ways))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(at, 2048) for at in range(0, b.num_rows, 2048)):
                x = rows_of(part.column("vector"))
                width = max(x.shape[1], points.value.shape[1])
                cell = distances(widen(x, width), widen(points.value, width)).argmin(axis=1)
                norm = np.minimum(squares(x), MOST).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(norm, pa.int64()), pa.array(cell, pa.int32())], names=[*part.schema.names, "norm", "cell"])

    apart = sound.groupBy("id", "label", "vector").agg(F.count("*").alias("n"))
    dealt = durable(apart.mapInArrow(deal, "id bigint, label " + apart.schema["label"].dataType.simpleString() + ", vector array<double>, n bigint, norm bigint, cell int"))
    sizes = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).collect()
    blocks = {r.cell: -(-r.n // max(64, block_rows * 128 // max(128, r.width))) for r in sizes}
    block = F.pmod(F.xxhash64("id", "label", "vector"), _of_cell(blocks, F.col("cell"))).cast("int")

    def plant(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        x, ids = rows_of(rows.column("vector")), rows.column("id")
        labels = pc.cast(rows.column("label"), pa.string()).to_numpy(zero_copy_only=False).astype(str)
        tree = Tree(x, ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(), labels, rows.column("n").to_numpy())
        width = max(x.shape[1], points.value.shape[1])
        d = distances(widen(x, width), widen(points.value, width))
        ends = (root_below(d).min(axis=0), root_above(d).max(axis=0))
        return pa.table(
            {"cell": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()), "tree": pa.array([pickle.dumps(tree)], pa.binary())}
            | {name: [[float(v) for v in end]] for name, end in zip(("least", "largest"), ends)}
            | {"norm_least": [float(tree.norms.min())], "norm_largest": [float(tree.norms.max())]}
        )

    trees = durable(dealt.withColumn("block", block).groupBy("cell", "block").applyInArrow(plant, "cell int, block int, tree binary, least array<double>, largest array<double>, norm_least double, norm_largest double"))
    ends = trees.select("cell", "norm_least", "norm_largest", F.posexplode(F.arrays_zip("least", "largest")))
    table = ends.groupBy("cell", "pos").agg(*[f(c).alias(a) for f, c, a in ((F.min, "col.least", "lo"), (F.max, "col.largest", "hi"), (F.min, "norm_least", "n_lo"), (F.max, "norm_largest", "n_hi"))]).collect()
    cells = sorted(blocks)
    shape = (len(points.value), len(cells))
    root = Ranges(points.value, np.zeros(shape), np.zeros(shape), np.zeros(len(cells)), np.zeros(len(cells)))
    for r in table:
        j = cells.index(r.cell)
        root.least[r.pos, j], root.largest[r.pos, j], root.norm_least[j], root.norm_largest[j] = r.lo, r.hi, r.n_lo, r.n_hi
    return Index(trees, dealt, root, cells, blocks)


def _of_cell(values: dict[int, int], cell: Column) -> Column:
    """A number for each cell; there are as few cells as the root has ways."""
    return F.coalesce(*[F.when(cell == c, F.lit(v)) for c, v in values.items()], F.lit(1))


def _asked(part: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors and windows of queries; those with fewer windows get empty ones."""
    x, lo, hi = rows_of(part.column("vector")), part.column("lo").to_pylist(), part.column("hi").to_pylist()
    most = max(map(len, lo), default=0)
    fill = lambda rows, v: np.array([r + [v] * (most - len(r)) for r in rows], dtype=np.int64).reshape(len(rows), most)
    return x, fill(lo, MOST), fill(hi, LEAST)


def _route(index: Index, queries: DataFrame) -> DataFrame:
    """``queries`` with ``cells``: those that one of their windows meets."""
    root = queries.sparkSession.sparkContext.broadcast((index.root, index.cells))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, cells = root.value
        for b in batches:
            for part in (b.slice(at, 2048) for at in range(0, b.num_rows, 2048)):
                x, lo, hi = _asked(part)
                norms = squares(x)
                meets = np.zeros((len(x), len(cells)), dtype=bool)
                for w in range(lo.shape[1]):
                    meets |= ranges.meet(x, norms, lo[:, w], hi[:, w])
                found = pa.array([[cells[j] for j in np.flatnonzero(m)] for m in meets], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, "cells"])

    wide = T.StructType([*queries.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    return queries.mapInArrow(each, wide)


def _search(index: Index, queries: DataFrame, asked: int, same: bool, most: int, chunk_rows: int = 8192) -> DataFrame:
    """(key, window, id, score, n): at least the first ``most`` rows of every window of ``queries`` (key, label, vector,
    lo, hi, cells), of the same label or of others. ``asked`` is about how many queries there are: they meet a
    block in chunks of about ``chunk_rows``."""
    chunks = max(1, -(-asked // chunk_rows))
    keys = ["cell", "block", "chunk"]
    to = queries.select("key", F.col("label").cast("string").alias("label"), "vector", "lo", "hi", F.explode("cells").alias("cell"))
    to = to.withColumn("block", F.explode(F.sequence(F.lit(0), _of_cell(index.blocks, F.col("cell")) - 1))).withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(chunks)).cast("int"))
    trees = index.trees.select("cell", "block", "tree", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    out = pa.schema([("key", pa.string()), ("window", pa.int32()), ("id", pa.int64()), ("score", pa.int64()), ("n", pa.int64())])

    def each(questions: pa.Table, held: pa.Table) -> pa.Table:
        parts = []
        if questions.num_rows and held.num_rows:
            x, lo, hi = _asked(questions)
            found = Queries(x, questions.column("label").to_numpy().astype(str), lo, hi, same)
            pickle.loads(held.column("tree")[0].as_py()).search(found, most)
            names = questions.column("key")
            for w, (q, score, ids, has_id, counts) in enumerate(found.best):
                parts.append(pa.table([names.take(pa.array(q)), pa.array(np.full(len(q), w), pa.int32()), pa.array(ids, pa.int64(), mask=~has_id), pa.array(score), pa.array(counts)], schema=out))
        return pa.concat_tables(parts) if parts else out.empty_table()

    return to.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInArrow(each, "key string, window int, id bigint, score bigint, n bigint")


def _first(found: DataFrame, most: int) -> DataFrame:
    """(key, window, rank, id, score): the first ``most`` of each window over all blocks, equal rows as often as they occur."""
    order = Window.partitionBy("key", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    few = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    upto = few.withColumn("before", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
    copies = F.explode(F.sequence(F.col("before") + 1, F.least(F.col("before") + F.col("n"), F.lit(most))))
    return upto.filter(F.col("before") < most).select("key", "window", copies.alias("rank"), "id", "score")


def mine(rows: DataFrame, is_anchor: Column, id: str = "vec_id", label: str = "label", vector: str = "embedding", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, ways: int = 16, block_rows: int = 4096) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows for which ``is_anchor``, a condition on the column ``id``, holds. Each has its first
    ``positives`` other rows of the same label, and each of these the first ``negatives`` rows of other labels with
    ``low`` to ``high`` hundredths of its score. Higher scores come first, equal ones by id.
    """
    plain = rows.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector"))
    index = build_index(plain, ways, block_rows=block_rows)
    key = F.sha2(F.to_json(F.struct("id", "label", "vector")), 256).alias("key")
    anchors = durable(index.rows.filter(is_anchor & F.col("id").isNotNull()).select(key, "id", "label", "vector", "n", "norm", "cell"))
    asked = anchors.count()
    most = positives + 1  # an anchor is a row of its own label, and leaves later
    everything = lambda lo: (F.array(lo).alias("lo"), F.array(F.lit(MOST)).alias("hi"))
    home = anchors.select("key", "label", "vector", *everything(F.lit(LEAST)), F.array("cell").alias("cells"))
    near = durable(_search(index, home, asked, True, most))
    reached = _first(near, most).groupBy("key").agg(F.min("score").alias("least"), F.count("*").alias("got"))
    enough = F.when(F.col("got") == most, F.col("least")).otherwise(F.lit(LEAST))
    beyond = anchors.join(reached, "key").select("key", "label", "vector", *everything(enough), "cell")
    elsewhere = _route(index, beyond).withColumn("cells", F.filter("cells", lambda c: c != F.col("cell")))
    best = _first(near.union(_search(index, elsewhere, asked, True, most)), most)
    units = best.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("units")).join(anchors.select("key", F.col("id").alias("anchor_id"), "label", "vector", "n", "norm"), "key")
    itself = F.array_position(F.transform("units", lambda u: u["id"].eqNullSafe(F.col("anchor_id")) & (u["score"] == F.col("norm"))), True)
    others = F.slice(F.filter("units", lambda u, i: i + 1 != itself), 1, positives)
    pairs = durable(units.select("key", "anchor_id", "label", "vector", "n", F.filter(others, lambda u: u["score"] >= 0).alias("units")).filter(F.size("units") > 0))
    share = lambda score, part, up: ((score.cast("decimal(38,0)") * part + F.lit(99 if up else 0)).cast("decimal(38,0)") / 100)
    lo = F.transform("units", lambda u: F.floor(share(u["score"], low, True)).cast("bigint")).alias("lo")
    hi = F.transform("units", lambda u: F.floor(share(u["score"], high, False)).cast("bigint")).alias("hi")
    found = _first(_search(index, _route(index, pairs.select("key", "label", "vector", lo, hi)), asked, False, negatives), negatives)
    given = pairs.select("key", "anchor_id", "n", F.posexplode("units").alias("window", "unit"))
    whole = given.join(found, ["key", "window"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    forget(near)
    return whole.select("anchor_id", F.col("unit.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("unit.score").alias("positive_score"), F.col("score").alias("negative_score"))
