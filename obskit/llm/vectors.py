"""Exact integer arithmetic on vectors, for the operators that search them.

Each component x becomes floor(scale * x). Products and distances are exact whatever the size of the components:
float64 matrix products while they stay below 2**53, int64 below 2**63, Python integers beyond.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components; false for a null one."""
    v = vector.cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & sound, F.lit(False))


def whole(values: np.ndarray, scale: int = 256) -> np.ndarray:
    """floor(scale * x) of doubles: int64, or Python integers if one is too large."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(scale))
    if not values.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    out = np.empty(values.shape, dtype=object)
    out.flat = [math.floor(x * scale) if abs(x) < 2.0**52 else int(x) * scale for x in values.ravel().tolist()]
    return out


def rows_of(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Scaled rows of a list column; shorter lists are filled up with 0 to the longest, or to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = whole(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    width = int(sizes.max(initial=0)) if width is None else width
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def widen(rows: np.ndarray, width: int) -> np.ndarray:
    return rows if rows.shape[1] >= width else np.concatenate([rows, np.zeros((len(rows), width - rows.shape[1]), dtype=rows.dtype)], axis=1)


def _largest(*arrays: np.ndarray) -> int:
    return max((int(max(a.max(), -a.min())) for a in arrays if a.size), default=0)


def _kind(bound: int) -> type:
    return np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``x`` with all rows of ``y`` (int64, or Python integers)."""
    kind = _kind(x.shape[1] * _largest(x) * _largest(y))
    out = x.astype(kind) @ y.astype(kind).T
    return out.astype(np.int64) if kind is not object else out


def squares(x: np.ndarray) -> np.ndarray:
    kind = _kind(x.shape[1] * _largest(x) ** 2)
    wide = x.astype(object if kind is object else np.int64)
    return (wide * wide).sum(axis=1) if x.shape[1] else np.zeros(len(x), dtype=np.int64)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances of all rows of ``x`` from all rows of ``y``."""
    kind = _kind(4 * x.shape[1] * _largest(x, y) ** 2)
    x, y = x.astype(kind), y.astype(kind)
    out = (x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)
    return out.astype(np.int64) if kind is not object else out


def root_below(squared: np.ndarray) -> np.ndarray:
    """Never above the root of an exact square, and close to it."""
    if squared.dtype == object:
        return np.array([math.isqrt(v) for v in squared.ravel().tolist()], dtype=object).reshape(squared.shape)
    return np.sqrt(squared.astype(np.float64)) * (1 - 1e-12)


def root_above(squared: np.ndarray) -> np.ndarray:
    """Never below the root of an exact square, and close to it."""
    if squared.dtype == object:
        return np.array([math.isqrt(v) + 1 for v in squared.ravel().tolist()], dtype=object).reshape(squared.shape)
    return np.sqrt(squared.astype(np.float64)) * (1 + 1e-12)


def longs(values: np.ndarray) -> pa.Array:
    """A column of longs, null where a number is none."""
    if values.dtype != object:
        return pa.array(values, pa.int64())
    return pa.array([v if -(2**63) <= v < 2**63 else None for v in values.tolist()], pa.int64())
