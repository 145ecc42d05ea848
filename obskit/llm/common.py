"""Small helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the word separator of every contract here.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a driver that is its own executor may do without: it has a private one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = getattr(shared_dir, "own", None)
    if own is None:
        own = shared_dir.own = tempfile.mkdtemp(prefix="obskit-")
    return own


#: Folders that ``durable`` has made and that nobody has removed yet.
_made: list[str] = []


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors.

    ``forget`` removes the folder of a result that nothing reads any more, ``purge`` those of all results.
    """
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/obskit-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.durable_path = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _made.remove(path)


def forget(df: DataFrame) -> None:
    """Remove the folder of ``df``, a result of ``durable`` that nothing will read again."""
    _remove(df.sparkSession, df.durable_path)


def purge(spark: SparkSession) -> None:
    """Remove what ``durable`` has written in this process, once the results built on it have been consumed."""
    for path in list(_made):
        _remove(spark, path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that where a text has one byte per character."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def held_out(doc_id: Column) -> Column:
    """True for the rows labels must not be learnt from: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def rows_with_text(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(row, text): ``keep`` (all columns, if None) packed in a struct, so that no name clashes, and the text. A struct
    that has the text already stands alone, so that Python gets it once; ``texts_of`` finds it in either."""
    names = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    return docs.select(row) if any(c.lower() == "text" for c in names) else docs.select(row, "text")


def texts_of(rows: pa.RecordBatch) -> pa.Array:
    """The texts of a batch of ``rows_with_text``, "" for null."""
    if "text" in rows.schema.names:
        found = rows.column("text")
    else:
        held = rows.column("row")
        found = held.field(next(i for i, f in enumerate(held.type) if f.name.lower() == "text"))
    return found.fill_null("")


def row_type(rows: DataFrame) -> str:
    return f"row {rows.schema['row'].dataType.simpleString()}"


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, parts: int = 1000) -> DataFrame:
    """``rows`` joined with ``groups`` (one row for each ``key``, with its number of rows in ``size``) on ``key``.

    Keys that hold over a ``parts``-th of the rows are fewer than ``parts``, however large the input: these groups
    are broadcast, so that their rows stay spread over tasks. All other rows meet their group in a shuffle.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) > total / parts
    often = [r[key] for r in groups.filter(hot).select(key).limit(parts).collect()]
    if not often:
        return rows.join(groups.hint("merge"), key)
    is_hot = F.col(key).isin(often)
    return rows.filter(~is_hot).join(groups.filter(~hot).hint("merge"), key).unionByName(rows.filter(is_hot).join(F.broadcast(groups.filter(hot)), key))
