"""Exact quantiles and ranks of groups of any size.

A group's values are never held by one task. Equal values of a group become one row with a count, and a monotone
bucket number of a value, logarithmic in its size, splits a group into buckets of values within 0.03 % of each other:
a few ten thousand in a group, whatever its number of rows. A value's position is a running sum over the counts of the
buckets before, and one over the values of its own bucket. Selection looks only into buckets that hold a wanted
position. Each result refers to its input twice, so plans stay small, and both read one exchange.

Nulls have no rank; NaN comes after all numbers. A null in a key is a key value like others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import fresh
from ..sources.storage import written

#: Buckets for each factor of e in size.
BUCKETS = 4096


def bucket(v: Column) -> Column:
    """A number that never falls as ``v`` grows, mirrored below 0."""
    size = F.least(F.ln(F.abs(v)) + 800.0, F.lit(1600.0))
    return F.when(F.isnan(v), F.lit(1 << 30)).when(v == 0, F.lit(0)).otherwise(F.floor(F.signum(v) * size * BUCKETS)).cast("int")


def join_on(a: DataFrame, b: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns where null matches null; each appears once. No columns: ``b`` is one row."""
    if not columns:
        return a.crossJoin(b)
    right = dict(zip(columns, fresh([*a.columns, *b.columns], *columns)))
    theirs = b.withColumnsRenamed(right)
    on = reduce(lambda x, y: x & y, [F.col(f"`{c}`").eqNullSafe(F.col(f"`{r}`")) for c, r in right.items()])
    return a.join(theirs, on, how).drop(*right.values())


def behind(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str], Callable[[DataFrame], DataFrame]]:
    """``df`` with its keys under names that nothing else has, these names, and what gives the keys theirs back."""
    inner = [f"key {i}" for i in range(len(keys))]
    return df.withColumnsRenamed(dict(zip(keys, inner))), inner, lambda out: out.withColumnsRenamed(dict(zip(inner, keys)))


def _distinct(df: DataFrame, keys: Sequence[str], value: Column, more: Sequence[Column] = ()) -> DataFrame:
    """keys, v, f, k: the values of each group with bucket and count."""
    v = df.withColumn("v", value.cast("double")).filter("v is not null")
    return v.groupBy(*keys, "v").agg(F.count("*").alias("k"), *more).withColumn("f", bucket(F.col("v")))


def _running(partition: Sequence[str], order: str) -> Column:
    """The sum of k over what comes before in the partition."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("k").over(w), F.lit(0))


def _buckets(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, f, before, n: how many rows of the group come before each bucket, and how many there are in all."""
    counts = values.groupBy(*keys, "f").agg(F.sum("k").alias("k"))
    return counts.withColumns({"before": _running(keys, "f"), "n": F.sum("k").over(Window.partitionBy(*keys))})


def _held(before: Column) -> Column:
    return F.filter("want", lambda p: (p >= before) & (p < before + F.col("k")))


def values_at(df: DataFrame, keys: Sequence[str], value: Column, wanted: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """keys, n, position, v: the values at 0-based positions of each group's order.

    ``wanted`` gets bucket rows with each group's size ``n`` and adds ``want``, an array of positions.
    """
    keys = list(keys)
    values = _distinct(df, keys, value)
    open_ = wanted(_buckets(values, keys)).withColumn("want", _held(F.col("before"))).filter(F.size("want") > 0).drop("k")
    found = join_on(values, open_, [*keys, "f"]).withColumn("before", F.col("before") + _running([*keys, "f"], "v"))
    return found.withColumn("position", F.explode(_held(F.col("before")))).select(*keys, "n", "position", "v")


def quantiles(df: DataFrame, keys: Sequence[str], value: Column | str, probs: Mapping[str, float]) -> DataFrame:
    """keys and one column for each of ``probs``: exact quantiles with linear interpolation, over groups with values."""
    df = df.select(*[F.col(f"`{k}`") for k in keys], (F.col(f"`{value}`") if isinstance(value, str) else value).alias("v"))
    df, keys, named = behind(df, keys)
    spot = {name: F.lit(float(p)) * (F.col("n") - 1) for name, p in probs.items()}
    ends = [f(s).cast("bigint") for s in spot.values() for f in (F.floor, F.ceil)]
    found = values_at(df, keys, F.col("v"), lambda rows: rows.withColumn("want", F.array_distinct(F.array(*ends))))

    def at(position: Column) -> Column:
        return F.max(F.when(F.col("position") == position, F.col("v")))

    out = []
    for name, s in spot.items():
        low, high = at(F.floor(s)), at(F.ceil(s))
        share = F.max(s - F.floor(s))
        out.append(F.when(share == 0, low).otherwise(low * (1 - share) + high * share).alias(name))
    return named(found.groupBy(*keys).agg(*out))


def ranked_values(df: DataFrame, keys: Sequence[str], value: Column | str, more: Sequence[Column] = ()) -> DataFrame:
    """keys, v, k, before, n, f and the aggregates ``more``: each group's distinct values, how many rows have them, how
    many have a smaller one, and how many there are. The mean rank of v's rows is before + (k + 1) / 2."""
    keys = list(keys)
    value = F.col(value) if isinstance(value, str) else value
    values = _distinct(df, keys, value, more)
    placed = join_on(values, _buckets(values, keys).drop("k"), [*keys, "f"])
    return placed.withColumn("before", F.col("before") + _running([*keys, "f"], "v"))


def mean_ranks(df: DataFrame, keys: Sequence[str], value: str, into: str) -> DataFrame:
    """``df`` with the rank of ``value`` in its group, from 1, ties sharing their mean."""
    bare, inner, named = behind(df.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{value}`").alias("v")), keys)
    ranks = ranked_values(bare, inner, "v").select(*inner, F.col("v").alias(value), (F.col("before") + (F.col("k") + 1) / 2).alias(into))
    return join_on(df, named(ranks), [*keys, value])


def least_from_above(ranked: DataFrame, keys: Sequence[str], value: Column, into: str) -> DataFrame:
    """Add to rows of ``ranked_values`` the least ``value`` among their group's rows of the same or a larger v."""
    keys = list(keys)
    rows = ranked.withColumn("x", value)
    after = F.min("x").over(Window.partitionBy(*keys).orderBy(F.desc("f")).rowsBetween(Window.unboundedPreceding, -1))
    above = rows.groupBy(*keys, "f").agg(F.min("x").alias("x")).select(*keys, "f", after.alias("above"))
    own = F.min("x").over(Window.partitionBy(*keys, "f").orderBy(F.desc("v")).rowsBetween(Window.unboundedPreceding, 0))
    return join_on(rows, above, [*keys, "f"]).withColumn(into, F.least("above", own)).drop("above", "x")


def numbered(df: DataFrame, order: Sequence[Column | str], into: str) -> DataFrame:
    """``df`` with each row's position in an order, from 1.

    Rows are dealt by ranges of the order and sorted in each, and written with the place they have there; the counts of the
    ranges, one number a task, give the offsets. No task sees more than a range. Rows alike in the whole order share a
    range, in any order, so it should end in a key. Runs when called.
    """
    place, part, before = fresh([*df.columns, into], "place", "part", "before")
    sorted_ = df.drop(into).repartitionByRange(*order).sortWithinPartitions(*order)
    # A place is the task's number above 33 bits that count its rows.
    placed = written(sorted_.withColumn(place, F.monotonically_increasing_id())).withColumn(part, F.shiftright(place, 33))
    counts = sorted((r[part], r["count"]) for r in placed.groupBy(part).count().collect())
    offsets = [(p, sum(n for _, n in counts[:i])) for i, (p, _) in enumerate(counts)]
    ahead = df.sparkSession.createDataFrame(offsets, f"`{part}` long, `{before}` long")
    row = F.col(place).bitwiseAND((1 << 33) - 1) + 1
    return placed.join(F.broadcast(ahead), part).withColumn(into, F.col(before) + row).drop(place, part, before)
