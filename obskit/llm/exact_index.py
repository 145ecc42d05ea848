"""Exact dedup against a persistent digest index.

The index is a table (digest, keep_id, batch), bucketed and sorted by digest. A batch is reduced to one row per digest,
anti-joined with the index by sort-merge (the index side needs no shuffle), and what is new is appended. A second
table lists the batches whose append has ended: readers see only these, so what a lost driver left half written never
counts, and the batch can simply be added again.

Defined cases: a null text counts as empty; a null id sorts below every id, and a group of null ids keeps one row;
of repeated rows (same id and text) one stays; an empty table gives no rows and leaves the index as it is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, durable, join_groups


def text_digest(text: Column) -> Column:
    """SHA-256 (binary) of the text with A-Z lower-cased."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256))


class DigestIndex:
    """A bucketed table of the digests seen so far, kept under its name. ``buckets`` holds for the life of the table."""

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None, location: str | None = None):
        self.spark, self.name, self.commits = spark, name, f"{name}_commits"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        at, beside = (f" LOCATION '{location}/{part}'" if location else "" for part in ("digests", "commits"))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS{at}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.commits} (batch STRING) USING parquet{beside}")
        if spark.table(name).columns != ["digest", "keep_id", "batch"]:
            raise ValueError(f"{name} is not a digest index")

    @classmethod
    def fresh(cls, spark: SparkSession) -> DigestIndex:
        return cls(spark, f"digest_index_{uuid.uuid4().hex}")

    def drop(self) -> None:
        for name in (self.name, self.commits):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def read(self) -> DataFrame:
        """(digest, keep_id) of the batches whose append has ended; one short row a batch is broadcast."""
        done = self.spark.table(self.commits).distinct()
        return self.spark.table(self.name).join(F.broadcast(done), "batch", "left_semi").select("digest", "keep_id")

    def append(self, digests: DataFrame, batch: str) -> None:
        """Write what is new in ``digests`` (digest, doc_id); of equal digests the largest id stays. Not yet seen."""
        reduced = digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        new = reduced.join(self.read().hint("merge"), "digest", "left_anti").withColumn("batch", F.lit(batch))
        new.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.name)

    def commit(self, batch: str) -> None:
        self.spark.createDataFrame([(batch,)], "batch string").coalesce(1).write.insertInto(self.commits)

    def add(self, digests: DataFrame) -> None:
        batch = uuid.uuid4().hex
        self.append(digests, batch)
        self.commit(batch)


def index_digests(digests: DataFrame, index: DigestIndex) -> None:
    """Put ``digests`` (doc_id, digest) into ``index`` as two batches, larger ids first, so that the largest id of a
    group stays; what an index held before stays ahead of both."""
    low, high = digests.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = 0 if low is None else (low + high) // 2
    late = F.coalesce(F.col("doc_id") > middle, F.lit(False))
    for batch in (digests.filter(late), digests.filter(~late)):
        index.add(batch)


def dedup_exact(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """doc_id, digest, keep_id, group_size, kept for every row of ``docs`` (doc_id, text), through ``index`` (None: one
    for this call, dropped when it has served)."""
    digests = durable(docs.select("doc_id", text_digest(F.col("text")).alias("digest")))
    held = index or DigestIndex.fresh(docs.sparkSession)
    index_digests(digests, held)
    groups = durable(digests.groupBy("digest").agg(F.count("*").alias("group_size")).join(held.read().hint("merge"), "digest"))
    if index is None:
        held.drop()
    once = F.row_number().over(Window.partitionBy("digest", "doc_id").orderBy("digest")) == 1
    joined = join_groups(digests, groups, "digest", "group_size")
    return joined.select("doc_id", "digest", "keep_id", "group_size", (once & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"))


def keep_one(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each text, the one whose id the index holds."""
    rows = durable(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_digest(F.col("text")).alias("digest")))
    held = index or DigestIndex.fresh(docs.sparkSession)
    index_digests(rows.select("row.doc_id", "digest"), held)
    kept = held.read()
    if index is None:
        kept = durable(kept)
        held.drop()
    kept = kept.withColumnRenamed("digest", "text_digest").hint("merge")
    once = F.row_number().over(Window.partitionBy("text_digest", "keep_id").orderBy("text_digest"))
    # The id is a join key too, so the copies of one text are dealt to many tasks.
    mine = rows.join(kept, (F.col("digest") == F.col("text_digest")) & F.col("row.doc_id").eqNullSafe(F.col("keep_id")))
    return mine.withColumn("n", once).filter("n = 1").select("row.*")
