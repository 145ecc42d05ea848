"""How many places lie in a rectangle around each place, without making pairs.

Where there are many, places are dealt into strips as wide as the rectangle's half width, so a rectangle meets its own
strip and the two beside it. All rectangles of a strip are counted together: places sorted by x form a wavelet matrix
over the order of y, prefix sums of weights at each of its levels, and a rectangle is a difference of two descents, one
step a level. m places and q rectangles take (m + q) log m steps. A crowded strip is cut by hash into blocks of bounded
size, whose counts are added.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranking import behind, join_on


def _ends(values: np.ndarray, at: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """[from, to) of the ascending, distinct ``values`` v with abs(v - at) <= reach, as floats round it."""
    lo, hi = np.searchsorted(values, at - reach, "left"), np.searchsorted(values, at + reach, "right")
    inside = lambda i: np.abs(values[np.clip(i, 0, len(values) - 1)] - at) <= reach
    for _ in range(2):  # the sums above round: no more than a neighbour is won or lost
        lo = lo - ((lo > 0) & inside(lo - 1))
        lo = lo + ((lo < len(values)) & ~inside(lo) & (lo < hi))
        hi = hi + ((hi < len(values)) & inside(hi))
        hi = hi - ((hi > lo) & ~inside(hi - 1))
    return lo, hi


def rectangle_sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, at_x: np.ndarray, at_y: np.ndarray, reach: float) -> np.ndarray:
    """For each (at_x, at_y) the weight of the places within ``reach`` both ways, the borders included."""
    order = np.argsort(x, kind="stable")
    x, y, weight = x[order], y[order], weight[order]
    xs, first = np.unique(x, return_index=True)
    ys, rank = np.unique(y, return_inverse=True)
    first = np.append(first, len(x))
    left, right = (first[e] for e in _ends(xs, at_x, reach))
    low, high = _ends(ys, at_y, reach)
    levels = max(1, int(len(ys)).bit_length())
    sums = np.zeros((2, len(at_x)), dtype=np.int64)  # of ranks below low, and below high
    edge = [(left.copy(), right.copy(), low), (left.copy(), right.copy(), high)]
    for level in range(levels - 1, -1, -1):
        bit = (rank >> level) & 1
        zeros = np.concatenate([[0], np.cumsum(1 - bit)])
        ahead = np.argsort(bit, kind="stable")
        rank, weight = rank[ahead], weight[ahead]
        upto = np.concatenate([[0], np.cumsum(weight)])
        for i, (l, r, below) in enumerate(edge):
            up = ((below >> level) & 1).astype(bool)
            zl, zr = zeros[l], zeros[r]
            sums[i] += np.where(up, upto[zr] - upto[zl], 0)
            edge[i] = (np.where(up, zeros[-1] + l - zl, zl), np.where(up, zeros[-1] + r - zr, zr), below)
    return sums[1] - sums[0]


def counts_around(places: DataFrame, keys: Sequence[str], x: str, y: str, weight: str, reach: float, into: str, block: int = 1_000_000) -> DataFrame:
    """keys, x, y and ``into``: for each of ``places`` (one row a place) the weight of those with the same keys whose x and
    y are at most ``reach`` away, itself included. ``block`` bounds the places that a task holds."""
    bare, inner, _ = behind(places.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{x}`").alias("x"), F.col(f"`{y}`").alias("y"), F.col(f"`{weight}`").cast("bigint").alias("w")), keys)
    bare = join_on(bare, bare.groupBy(*inner).agg((F.count("*") <= block).alias("few")), inner)
    strip = F.floor(F.col("x") / (reach * (1 + 1e-9)))  # a little wider, so that rounding leads to no third strip
    own = bare.withColumn("strip", F.when(F.col("few"), F.lit(0)).otherwise(strip))
    beside = F.when(F.col("few"), F.array(F.lit(0).cast("bigint"))).otherwise(F.array(strip - 1, strip, strip + 1))
    around = bare.withColumn("strip", F.explode(beside))
    at = [*inner, "strip"]
    sizes = around.groupBy(*at).agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    part: Column = F.pmod(F.xxhash64("x", "y"), F.col("parts")).cast("int")
    each_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    held = join_on(around, sizes, at).withColumn("part", part).withColumn("asked", each_part).select(*at, "part", "asked", "x", "y", "w")
    asked = join_on(own, sizes, at).withColumn("asked", part).withColumn("part", each_part).select(*at, "part", "asked", "x", "y")
    asked = asked.toDF(*asked.columns)  # columns of its own: both sides come from the same places
    kinds = T.StructType([*[f for f in asked.schema.fields if f.name not in ("part", "asked", "strip")], T.StructField("sum", T.LongType())])
    names = kinds.names[:-1]

    def count(mine: pa.Table, all_: pa.Table) -> pa.Table:
        col = lambda t, c: t.column(c).to_numpy()
        if not mine.num_rows or not all_.num_rows:
            sums = np.zeros(mine.num_rows, dtype=np.int64)
        else:
            sums = rectangle_sums(col(all_, "x"), col(all_, "y"), col(all_, "w"), col(mine, "x"), col(mine, "y"), reach)
        return mine.select(names).append_column("sum", pa.array(sums, pa.int64()))

    together = [*at, "part", "asked"]
    found = asked.groupBy(*together).cogroup(held.groupBy(*together)).applyInArrow(count, kinds)
    out = found.groupBy(*inner, "x", "y").agg(F.sum("sum").alias(into))
    return out.select(*[F.col(i).alias(k) for i, k in zip(inner, keys)], F.col("x").alias(x), F.col("y").alias(y), into)
