"""Sharding by weighted rendezvous hashing of record keys.

Every (key, shard) pair has a keyed score; a record lives in the shard with the best one. A new shard changes only
the records it wins, and no two old shards exchange any.

Defined cases: a null key is one key of its own; repeated rows share a shard and get slots of their own; a null
text has no bytes and checksum 0; an empty table gives no rows; other columns pass through unread, but those named
``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rendezvous(key: Column, weights: Sequence[float], seed: int = 7) -> Column:
    """The shard (position in ``weights``) with the largest ``-weight / ln(u)``, u a keyed hash in (0, 1).

    A shard of weight 0 gets nothing. Ties go to the lower shard.
    """
    shards = [(i, w) for i, w in enumerate(weights) if w > 0]
    if not shards:
        raise ValueError("no shard has a weight above 0")
    scores = []
    for i, w in shards:
        unit = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed), F.lit(i)), 11).cast("double") + 0.5) / float(1 << 53)
        scores.append(F.struct((F.lit(-float(w)) / F.ln(unit)).alias("score"), F.lit(-i).alias("shard")))
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return -best["shard"]


def record_key(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("k"), column.cast("string")), F.lit("null"))


def assign_shards(records: DataFrame, key: str, weights: Sequence[float], order: Sequence[str], buckets: int | None = None, seed: int = 7) -> DataFrame:
    """Add ``shard`` and ``slot``, gapless from 0 within a shard.

    A shard may be too large for one task, so it's cut into ``buckets`` (64, or the session's shuffle partitions if
    more) by a second hash: rows are numbered within (shard, bucket), and the counts of the buckets before, at most
    shards x buckets numbers, are added. Rows that agree in key and order columns share a bucket.
    """
    buckets = buckets or max(64, int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    k = record_key(F.col(f"`{key}`"))
    row = F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("row")
    bucket = F.pmod(F.xxhash64(k, *[F.col(f"`{c}`") for c in order]), F.lit(buckets)).cast("int")
    placed = records.select(row, rendezvous(k, weights, seed).alias("shard"), bucket.alias("bucket"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "bucket").count()
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "bucket").orderBy(*[F.col("row")[c] for c in (key, *order)])
    numbered = placed.withColumn("n", F.row_number().over(within)).join(F.broadcast(offsets), ["shard", "bucket"])
    kept = [c for c in records.columns if c.lower() not in ("shard", "slot")]
    return numbered.select(*[F.col("row")[c].alias(c) for c in kept], "shard", (F.col("before") + F.col("n") - 1).alias("slot"))
