"""Exact medians and median deviations in two scans, whatever the size and spread of a group.

The first scan gives each group a mergeable summary: ``percentile_approx`` at evenly spaced shares. Its ranks are off by
1 / ``ACCURACY`` of the group at most, so its points surely enclose the median, and enclose the median absolute
deviation from any number that the median may be. The second scan counts the rows that lie beyond these brackets and
keeps the values inside, about a hundredth of a group; equal ones are one row. Only these are shuffled. The values at
the wanted positions are then selected by bucket counts within the bracket, so no task holds a group there either.

Brackets are proved, not assumed: a position outside its bracket makes the query fail.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import written
from .ranking import behind, join_on

#: Steps of the summary, and the inverse of its largest rank error. A step must exceed three errors.
STEPS, ACCURACY = 400, 4000
#: Equal buckets of a bracket in which positions are looked up.
BUCKETS = 4096


def summary(value: Column) -> Column:
    """An aggregate for the first scan: points at 0, 1/STEPS, ... 1 of the order of ``value``, then two around the middle."""
    around = 2 / ACCURACY
    shares = [i / STEPS for i in range(STEPS + 1)] + [0.5 - around, 0.5 + around]
    return F.percentile_approx(value, shares, ACCURACY)


def brackets(points: Column) -> Column:
    """(lo, hi, near, far) from a ``summary``: the median lies in [lo, hi], and the median deviation in [near, far]."""
    lo, hi = F.get(points, F.lit(STEPS + 1)), F.get(points, F.lit(STEPS + 2))
    at = lambda i, more: F.get(points, i + more)
    wide, narrow = STEPS // 2 + 1, STEPS // 2 - 1
    # [x(i), x(i + wide)] holds more than half of the group: a deviation that covers it from anywhere is large enough.
    far = F.array_min(F.transform(F.sequence(F.lit(0), F.lit(STEPS - wide)), lambda i: F.greatest(at(i, wide) - lo, hi - at(i, 0))))
    # Fewer than half lie between x(i) and x(i + narrow): a deviation that stays inside is too small.
    near = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(STEPS - narrow)), lambda i: F.least(at(i, narrow) - hi, lo - at(i, 0))))
    room = 1e-12 * (F.abs(lo) + F.abs(hi) + F.abs(far))
    return F.struct(lo.alias("lo"), hi.alias("hi"), (near - room).alias("near"), (far + room).alias("far"))


def _running(k: Column, partition: Sequence[str], order: str) -> Column:
    """The sum of ``k`` over what comes before in the partition."""
    return F.coalesce(F.sum(k).over(Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _middle(before: Column, k: Column, value: Column) -> Column:
    """An aggregate: the mean of the values at the two middle positions of ``n``; null if one is not there."""
    at = lambda p: F.max(F.when((p >= before) & (p < before + k), value))
    return (at(F.floor((F.col("n") - 1) / 2)) + at(F.floor(F.col("n") / 2))) / 2


def _together(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, median, mad where all kept values are few: one exchange, each group's values sorted in one task."""
    of = Window.partitionBy(*keys)
    k, middle, candidate = F.col("k"), F.col("zone.middle"), F.col("zone.candidate")
    only = lambda flag: F.when(flag, k).otherwise(0)
    rows = counted.withColumns({"n": F.sum(k).over(of), "first": F.sum(only(F.col("zone.below"))).over(of), "close": F.sum(only(F.col("zone.close"))).over(of), "before": _running(only(middle), keys, "v")})
    at = lambda p: F.max(F.when(middle & (p >= F.col("first") + F.col("before")) & (p < F.col("first") + F.col("before") + k), F.col("v"))).over(of)
    rows = rows.withColumn("median", (at(F.floor((F.col("n") - 1) / 2)) + at(F.floor(F.col("n") / 2))) / 2)
    rows = rows.withColumn("off", F.when(candidate, F.abs(F.col("v") - F.col("median"))))
    rows = rows.withColumn("before", F.col("close") + _running(only(candidate), keys, "off"))
    return rows.groupBy(*keys).agg(F.max("median").alias("median"), _middle(F.col("before"), only(candidate), F.col("off")).alias("mad"))


def _select(values: DataFrame, keys: Sequence[str], low: Column, high: Column, first: Column, into: str) -> DataFrame:
    """keys and the mean of the values at the two middle positions of ``n``, ``first`` rows of which come before all
    ``values`` (keys, v, k, n, ...), which lie in [low, high]. Counts of equal buckets tell where to look."""
    share = F.when(high > low, (F.col("v") - low) / (high - low)).otherwise(0.0)
    bucket = F.floor(F.least(F.lit(BUCKETS - 1.0), F.greatest(F.lit(0.0), share * BUCKETS))).cast("int")
    rows = values.select(*keys, "v", "k", "n", first.alias("first"), bucket.alias("f"))
    counts = rows.groupBy(*keys, "f").agg(F.sum("k").alias("k"), F.max("n").alias("n"), F.max("first").alias("first"))
    before = counts.withColumn("before", F.col("first") + _running(F.col("k"), keys, "f"))
    holds = lambda p: (p >= F.col("before")) & (p < F.col("before") + F.col("k"))
    placed = before.filter(holds(F.floor((F.col("n") - 1) / 2)) | holds(F.floor(F.col("n") / 2))).select(*keys, "f", "before")
    inside = join_on(rows, placed, [*keys, "f"]).withColumn("before", F.col("before") + _running(F.col("k"), [*keys, "f"], "v"))
    return inside.groupBy(*keys).agg(_middle(F.col("before"), F.col("k"), F.col("v")).alias(into))


def _apart(counted: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same for any number of kept values: no task holds those of a group."""
    z = lambda c: F.col(f"zone.{c}")
    sums = counted.groupBy(*keys).agg(*[F.coalesce(F.sum(F.when(z(c), F.col("k"))), F.lit(0)).alias(c) for c in ("below", "close")])
    held = join_on(counted.filter(z("middle") | z("candidate")), join_on(known, sums, keys), keys)
    medians = _select(held.filter(z("middle")), keys, F.col("b.lo"), F.col("b.hi"), F.col("below"), "median")
    off = join_on(held.filter(z("candidate")), medians, keys).withColumn("v", F.abs(F.col("v") - F.col("median")))
    return join_on(medians, _select(off, keys, F.greatest(F.col("b.near"), F.lit(0.0)), F.col("b.far"), F.col("close"), "mad"), keys)


def median_and_deviation(rows: DataFrame, summaries: DataFrame, keys: Sequence[str], value: str, few: int = 5_000_000) -> DataFrame:
    """keys, median, mad of the non-null ``value`` of every group of ``rows``; ``value`` is a column that ``keys`` don't name.

    ``summaries`` has the keys, ``bracket`` (``brackets`` of a summary of the value) and ``n``, how many values there are. It
    should be a written table: then Spark knows its size when it joins the rows with it. Up to ``few`` kept values, which
    are counted, are sorted group by group; more are looked up by buckets.
    """
    bare, inner, named = behind(rows.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{value}`").cast("double").alias("v")).filter("v is not null"), keys)
    known, _, _ = behind(summaries.filter("n > 0").select(*[F.col(f"`{k}`") for k in keys], "n", F.col("bracket").alias("b")), keys)
    lo, hi, near, far = (F.col(f"b.{c}") for c in ("lo", "hi", "near", "far"))
    v = F.col("v")
    close = (near > 0) & (v < lo + near) & (v > hi - near)
    candidate = ~close & (v <= hi + far) & (v >= lo - far)
    zone = F.struct((v < lo).alias("below"), close.alias("close"), candidate.alias("candidate"), v.between(lo, hi).alias("middle"))
    kept = join_on(bare, known, inner).select(*inner, zone.alias("zone"), F.when(v.between(lo, hi) | candidate, v).alias("v"))
    counted = written(kept.groupBy(*inner, "zone", "v").agg(F.count("*").alias("k")))
    found = _together(counted, inner) if counted.count() <= few else _apart(counted, known, inner)
    sure = lambda c: F.coalesce(F.col(c), F.raise_error(F.lit(f"the {c} lies outside its bracket")).cast("double")).alias(c)
    return named(found.select(*inner, sure("median"), sure("mad")))
