"""Samples with a rule: quotas, coverage, even spacing, top k. All are reproducible, with explicit order columns.

The limits here are the features themselves. Row positions over a whole table come from ``with_positions``: counts of
range partitions are added up, so no task ever sees the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import scratch
from ..sources.storage import written
from .ranking import join_on, ranked_values
from .screening import cell_index


@scratch("_k")
def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, k: int) -> DataFrame:
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_k") <= k).drop("_k")


def water_fill(sizes: dict, cap: int) -> dict:
    """Equal quotas that add up to ``cap``; what a small group leaves goes to the others, first ones first."""
    quota, left = dict.fromkeys(sizes, 0), cap
    while left > 0 and (open_ := [k for k in sorted(sizes) if quota[k] < sizes[k]]):
        share = max(1, left // len(open_))
        for k in open_:
            take = min(share, sizes[k] - quota[k], left)
            quota[k] += take
            left -= take
    return quota


@scratch("_k")
def balanced_cap(df: DataFrame, cap: int, order: Sequence[str], by: str = "medium", most_groups: int = 1000) -> DataFrame:
    """At most ``cap`` rows, shared out over the values of ``by`` (up to ``most_groups``), the first of each in order."""
    sizes = {r[0]: r["n"] for r in df.groupBy(by).agg(F.count("*").alias("n")).limit(most_groups + 1).collect()}
    if len(sizes) > most_groups:
        raise ValueError(f"{by} has over {most_groups} values")
    named = {("" if k is None else str(k)): n for k, n in sizes.items()}
    quota = water_fill(named, cap)
    if not quota:
        return df.limit(0)
    key = F.coalesce(F.col(by).cast("string"), F.lit(""))
    allowed = F.try_element_at(F.create_map(*[F.lit(x) for kv in quota.items() for x in kv]), key)
    # The literal bound lets each task drop most rows before the shuffle; the quota decides after it.
    ranked = df.withColumn("_k", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("_k") <= max(quota.values()))
    return ranked.filter(F.col("_k") <= allowed).drop("_k")


def with_positions(df: DataFrame, order: Sequence[str], into: str = "position") -> DataFrame:
    """Add the 1-based position of each row in a total order whose first column is a number.

    The first column's values are ranked by buckets (``ranking``), so no task sees the table, however large; rows of
    one value are numbered among themselves. Rows without that number come last.
    """
    first, rest = order[0], list(order[1:])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    keyed = df.select(row, F.coalesce(F.col(f"`{first}`").cast("double"), F.lit(float("nan"))).alias("v"))
    before = ranked_values(keyed, [], "v").select("v", "before")
    numbered = keyed.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy(*[F.col("row")[c] for c in (rest or [first])])))
    placed = join_on(numbered, before, ["v"])
    kept = [c for c in df.columns if c.lower() != into.lower()]
    return placed.select(*[F.col("row")[c].alias(c) for c in kept], (F.col("before") + F.col("r")).alias(into))


@scratch("_p")
def evenly_spaced_sample(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """``n`` rows spread over the order, both ends included."""
    total = df.count()
    if not total or n < 1:
        return df.limit(0)
    if n >= total:
        return df
    spots = [1] if n == 1 else sorted({1 + i * (total - 1) // (n - 1) for i in range(n)})
    return with_positions(df, order, "_p").filter(F.col("_p").isin(*spots)).drop("_p")


@scratch("_n", "_over", "_p")
def round_robin_sample(df: DataFrame, key: str, bucket_cols: Sequence[str], order: Sequence[str], per_key: int, cap: int) -> DataFrame:
    """``per_key`` rows of each key: one of each bucket in turn, up to ``cap`` of a bucket, then the overflow."""
    n = F.row_number().over(Window.partitionBy(key, *bucket_cols).orderBy(*order))
    turns = df.withColumn("_n", n).withColumn("_over", (F.col("_n") > cap).cast("int"))
    pick = F.row_number().over(Window.partitionBy(key).orderBy("_over", "_n", *bucket_cols, *order))
    return turns.withColumn("_p", pick).filter(F.col("_p") <= per_key).drop("_n", "_over", "_p")


@scratch("_s", "_k", "_size")
def balanced_layer_sample(df: DataFrame, layer: str, cap: int, order: Sequence[str], special: Column) -> DataFrame:
    """Every layer cut to the smallest layer's size and the cap; a ``special`` row comes first where there is one.

    No row beyond the first ``cap`` of its layer and kind can stay, so tasks drop these before anything is shuffled.
    """
    least = df.groupBy(layer).agg(F.count("*").alias("n")).agg(F.least(F.min("n"), F.lit(cap)).alias("_size"))
    one = F.row_number().over(Window.partitionBy(layer, special).orderBy(*order))
    near = df.withColumn("_s", one).filter(F.col("_s") <= cap)
    first = (special & (F.col("_s") == 1)).cast("int")
    k = F.row_number().over(Window.partitionBy(layer).orderBy(F.desc(first), *order))
    return near.withColumn("_k", k).filter(F.col("_k") <= cap).crossJoin(least).filter(F.col("_k") <= F.col("_size")).drop("_s", "_k", "_size")


def unit_hash(unit: Column, seed: int) -> Column:
    """60 bits of the MD5 of a unit and the seed."""
    return F.conv(F.substring(F.md5(F.concat_ws("#", unit.cast("string"), F.lit(str(seed)))), 1, 15), 16, 10).cast("bigint")


def coverage_preserving_sample(obs: DataFrame, flagged: DataFrame, limit: int, strata: Sequence[str], degrees: Sequence[float] = (1.0, 2.0, 5.0, 10.0, 30.0), unit: str = "sample_id", seed: int = 5) -> DataFrame:
    """Whole units (samples): all with a candidate, at least one of each stratum and grid cell, then more by hash until
    ``limit`` rows.

    Cells start at the first of ``degrees`` and grow until what must be kept fits, at last without cells. Units kept for
    coverage stay even if they alone exceed the limit then. The first units of all cell sizes come from one aggregate
    over the rows, as the first of a coarse cell is the first of those of the fine cells in it; the size is chosen within
    the plan, so that building it runs no job.
    """
    h = unit_hash(F.col(unit), seed)
    sizes = obs.groupBy(unit).agg(F.count("*").alias("n")).withColumn("h", h)
    cells = []
    for d in degrees:
        x, y = cell_index(F.col("lon"), F.col("lat"), d)
        cells.append(F.when(F.col("lon").isNotNull(), y * 100_000 + x).cast("bigint"))
    first = F.min(F.struct(h.alias("h"), F.col(unit).alias("unit"))).alias("first")
    layers = [F.col(f"`{c}`").alias(f"layer {i}") for i, c in enumerate(strata)]
    names = [f"layer {i}" for i in range(len(strata))]
    fine = obs.groupBy(*layers, F.array(*cells, F.lit(0).cast("bigint")).alias("cells")).agg(first)
    each = fine.select(*names, "first", F.posexplode("cells").alias("level", "cell"))
    reps = each.groupBy(*names, "level", "cell").agg(F.min("first").alias("first")).select("level", F.col("first.unit").alias(unit))
    must = flagged.select(unit).distinct()
    last = len(degrees)
    forced_of = reps.union(must.select(F.explode(F.sequence(F.lit(0), F.lit(last))).alias("level"), unit)).distinct()
    needed = sizes.join(forced_of, unit).groupBy("level").agg(F.sum("n").alias("needed"))
    chosen = needed.agg(F.coalesce(F.min(F.when(F.col("needed") <= limit, F.col("level"))), F.lit(last)).alias("level"))
    forced = forced_of.join(F.broadcast(chosen), "level").select(unit)  # one row
    ranked = sizes.join(forced.withColumn("first", F.lit(0)), unit, "left").withColumn("first", F.coalesce("first", F.lit(1)))
    positions = with_running_sum(ranked, ["first", "h", unit], "n")
    keep = positions.filter((F.col("first") == 0) | (F.col("running") <= limit)).select(unit)
    return obs.join(keep, unit, "left_semi")


@scratch("_b", "_t", "_o", "_w")
def with_running_sum(df: DataFrame, order: Sequence[str], value: str) -> DataFrame:
    """Add ``running``: the sum of ``value`` up to each row. The second order column is a hash of 60 bits; the totals of
    its 4096 ranges are added, so a window sees a 4096th of the rows."""
    dealt = df.withColumn("_b", F.struct(F.col(order[0]), F.shiftright(F.col(order[1]), 48).alias("hi")))
    before = dealt.groupBy("_b").agg(F.sum(value).alias("_t")).withColumn("_o", F.coalesce(F.sum("_t").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_t")
    within = F.sum(value).over(Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.withColumn("_w", within).join(before, "_b").withColumn("running", F.col("_o") + F.col("_w")).drop("_b", "_o", "_w")


def review_sample(df: DataFrame, n: int, order: Sequence[str], classes: Sequence[str], group: str, value: str) -> DataFrame:
    """Rows for review with their first reason: quarter positions, the first of each class, each group's least and
    greatest value, and an even spread up to ``n``. The rows with their positions are written to the shared folder, as
    each reason reads them."""
    placed = written(with_positions(df, order, "position"))
    total = placed.count()
    picks = [placed.filter(F.col("position").isin(*sorted({1 + i * (total - 1) // 4 for i in range(5)}))).select("position", F.lit(1).alias("why"))]
    for i, c in enumerate(classes):
        picks.append(placed.groupBy(c).agg(F.min("position").alias("position")).select("position", F.lit(2 + i)))
    own = placed.filter(F.col(value).isNotNull()).groupBy(group)
    for m in (F.min_by("position", F.struct(value, "position")), F.max_by("position", F.struct(F.col(value), -F.col("position")))):
        picks.append(own.agg(m.alias("position")).select("position", F.lit(20)))
    if total and n > 1:
        picks.append(placed.filter(F.col("position").isin(*sorted({1 + i * (total - 1) // (n - 1) for i in range(n)}))).select("position", F.lit(30)))
    every = picks[0]
    for p in picks[1:]:
        every = every.union(p)
    chosen = every.groupBy("position").agg(F.min("why").alias("why")).orderBy("why", "position").limit(n)
    return placed.join(F.broadcast(chosen), "position")
