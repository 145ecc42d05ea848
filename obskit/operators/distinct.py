"""Exact distinct counts at every level of a roll-up, as sums.

The rows of one counted thing (a sample, say) are sorted by the roll-up's keys. A row is the thing's first one at level n
(under its first n keys) exactly if it differs from the row before it in one of these. So every row carries one
number, the first key it differs in, and "distinct at level n" becomes a sum over rows whose number is at most n: it is
added up by all keys at once, map-side, and from one level to the next. Rows are never multiplied for levels, and no set is
held anywhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import join_on


def first_level(thing: str, keys: Sequence[str], where: Column | None = None) -> Column:
    """The least number of keys under which a row is its ``thing``'s first one, 0 for the first of all; null where no number
    of keys makes it one. With ``where`` only rows for which it holds are looked at, and others are null."""
    window = Window.partitionBy(thing).orderBy(*keys)
    now = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    if where is None:
        before = F.lag(now).over(window)
    else:
        before = F.last(F.when(where, now), ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))
    out = F.lit(None).cast("int")
    for i in reversed(range(len(keys))):
        out = F.when(~now[f"k{i}"].eqNullSafe(before[f"k{i}"]), i + 1).otherwise(out)
    out = F.when(before.isNull(), 0).otherwise(out)
    return out if where is None else F.when(where, out)


def _by_level(name: str, number: Column, levels: Sequence[int]) -> list[Column]:
    return [F.count_if(number <= n).alias(f"{name} {n}") for n in levels]


def distinct_by_keys(rows: DataFrame, keys: Sequence[str], thing: str, name: str, levels: Sequence[int], where: Mapping[str, Column] | None = None, few: bool = True) -> DataFrame:
    """keys and a column "name n" for each of ``levels``: sums to be added over the rows that share their first n keys give
    the number of distinct non-null values of ``thing``. ``where`` counts, under other names, those with a row for which
    a condition holds. ``few``: equal rows are merged first, as a thing with few values has many of them."""
    rows = rows.filter(F.col(thing).isNotNull())
    if few and not where:
        rows = rows.select(*keys, thing).distinct()
    conditions = {name: None, **(where or {})}
    marked = rows.select(*keys, *[first_level(thing, keys, c).alias(n) for n, c in conditions.items()])
    return marked.groupBy(*keys).agg(*[c for n in conditions for c in _by_level(n, F.col(n), levels)])


def rolled_up(finest: DataFrame, keys: Sequence[str], sums: Sequence[str], counts: Sequence[str], levels: Sequence[int]) -> DataFrame:
    """level, keys (null beyond the level), ``sums`` and ``counts`` from rows by all keys, as ``distinct_by_keys`` gives."""
    cols = [F.col(k) for k in keys]
    many = finest.groupingSets([cols[:n] for n in levels], *cols).agg(
        F.grouping_id().alias("bits"), *[F.sum(c).alias(c) for c in sums], *[F.sum(f"`{c} {n}`").alias(f"{c} {n}") for c in counts for n in levels]
    )
    # A level of n keys has its last ones grouped away: bits 2**(keys - n) - 1.
    at = {n: (1 << (len(keys) - n)) - 1 for n in levels}
    pick = lambda c: reduce(lambda out, n: F.when(F.col("bits") == at[n], F.col(f"`{c} {n}`")).otherwise(out), levels, F.lit(None).cast("bigint"))
    level = reduce(lambda out, n: F.when(F.col("bits") == at[n], n).otherwise(out), levels, F.lit(None).cast("int"))
    return many.select(level.alias("level"), *keys, *sums, *[F.coalesce(pick(c), F.lit(0)).alias(c) for c in counts])


def together(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows by all keys side by side; the first part has every key, what others lack is 0."""
    out = parts[0]
    for p in parts[1:]:
        out = join_on(out, p, keys, "left")
    return out.fillna(0, [c for c in out.columns if c not in keys])
