"""Tables written once in the folder that a cluster shares, so that later steps read them instead of computing them anew."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders made in this process that ``purge`` has not removed yet, and the private folder of a local session.
_made: list[str] = []
_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Without it only a driver that is its own executor has a place: a private one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="obskit-"))
    return _own[0]


def new_folder(spark: SparkSession) -> str:
    """A path in the shared folder that nothing has used; ``purge`` removes what is written there."""
    path = f"{shared_folder(spark)}/obskit-{uuid.uuid4().hex}"
    _made.append(path)
    return path


#: For large tables of texts: a third smaller than Spark's own choice, for a little more time.
DENSE = {"compression": "zstd"}


def written(df: DataFrame, **options: str) -> DataFrame:
    """``df`` written as Parquet, with the writer's ``options``, and read back. Cuts the lineage, survives lost executors, and
    gives Spark the table's true size, so that a small one is broadcast and a large one is not."""
    path = new_folder(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_splits(spark: SparkSession, share: int = 4) -> Iterator[None]:
    """Files read by what runs within it come in ``share`` splits a core or more, so that the last ones don't leave cores idle;
    for rows that are cheap to read and dear to compute. The session's setting is as before afterwards."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(share * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def purge(spark: SparkSession) -> None:
    """Remove what this process has written, once the results built on it have been consumed."""
    while _made:
        place = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
