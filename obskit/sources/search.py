"""Word search over a stored index of entities.

An entity is (kind, entity_id, text). Entities are dealt to blocks by a hash of their id, and the index holds for each
word, kind and block the ids of the entities whose text has the word. A block has about ``block`` entities however
many there are, so no list outgrows it and a word that most texts have is spread over as many rows and tasks as
there are blocks. Rows lie in folders by a hash of the word, in each file by the word: a search reads the folders of its
words, in them the pages that may have these words, and meets the lists of its words block by block.

Defined cases: case does not matter; words are runs of letters and digits; a null or empty text has no words; a
search without words finds nothing; rows of one kind and id are one entity with the words of them all; an entity without
an id is left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import fresh
from .storage import DENSE, written
from .tables import archive_views, distinct_words, words_of

POSTINGS = "token string, kind string, block bigint, ids array<string>, bucket bigint"


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets))


def build_index(entities: DataFrame, path: str, buckets: int = 64, block: int = 4096, stored: bool = False) -> None:
    """Write the index of ``entities`` (kind, entity_id, text) to ``path``. What tells a reader its shape is written
    last, so an index whose writing broke off is not one.

    Entities are read twice, for their number and their words: they are written before, as they may be the union of many
    joins, unless ``stored`` says that they are cheap to read. Words are shuffled once, as they are, to the task that makes and
    writes their lists: lists made before would be sorted, and spilled, where the entities are read.
    """
    spark = entities.sparkSession
    entities = entities.select("kind", F.col("entity_id").cast("string").alias("entity_id"), "text")
    if not stored:
        entities = written(entities, **DENSE)
    blocks = entities.count() // block + 1
    words = entities.select("kind", "entity_id", F.explode(words_of(F.col("text"))).alias("token"))
    dealt = words.filter("token <> '' and entity_id is not null").withColumn("block", F.pmod(F.xxhash64("entity_id"), F.lit(blocks)))
    met = dealt.repartition("token", "kind", "block")
    lists = met.groupBy("token", "kind", "block").agg(F.array_sort(F.collect_set("entity_id")).alias("ids")).withColumn("bucket", _bucket(F.col("token"), buckets))
    lists.sortWithinPartitions("bucket", "token", "kind", "block").write.options(**DENSE).partitionBy("bucket").parquet(f"{path}/postings")
    spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(blocks).alias("blocks")).write.parquet(f"{path}/shape")


def _lists(spark: SparkSession, path: str, wanted: Sequence[str], kinds: Sequence[str] | None) -> DataFrame:
    buckets = spark.read.parquet(f"{path}/shape").first().buckets
    postings = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
    lists = postings.filter(F.col("bucket").isin(*[_bucket(F.lit(w), buckets) for w in wanted]) & F.col("token").isin(*wanted))
    return lists.filter(F.col("kind").isin(*kinds)) if kinds else lists


def search_index(spark: SparkSession, path: str, query: str, kinds: Sequence[str] | None = None) -> DataFrame:
    """(kind, entity_id) of the entities, of ``kinds`` if given, whose text has every word of ``query``."""
    wanted = distinct_words(query)
    lists = _lists(spark, path, wanted, kinds)
    every = lists.groupBy("kind", "block").agg(F.collect_list("ids").alias("lists")).filter(F.size("lists") == len(wanted)) if wanted else lists.select("kind", "block", F.array("ids").alias("lists")).limit(0)
    return every.select("kind", F.explode(F.aggregate("lists", F.get("lists", F.lit(0)), F.array_intersect)).alias("entity_id"))


def archive_entities(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The datasets, publications, events, samples and methods of an archive with the text each is found by."""
    texts = {
        "dataset": ("datasets", "dataset_id", ["title", "dataset_id"]),
        "publication": ("publications", "publication_id", ["citation", "title", "doi"]),
        "event": ("events", "event_id", ["place"]),
        "sample": ("samples", "sample_id", ["sample_id", "medium", "lithology", "description"]),
        "method": ("methods", "method_id", ["family", "technique", "laboratory"]),
    }
    parts = [tables[t].select(F.lit(kind).alias("kind"), F.col(key).alias("entity_id"), F.concat_ws(" ", *text).alias("text")) for kind, (t, key, text) in texts.items()]
    return reduce(DataFrame.union, parts)


def observations_found(tables: Mapping[str, DataFrame], hits: DataFrame) -> DataFrame:
    """The rows of observation_search that ``hits`` (kind, entity_id) touch: by their dataset, event, sample or method, or by
    a publication about their method."""
    of = lambda kind, name: hits.filter(F.col("kind") == kind).select(F.col("entity_id").alias(name))
    by_paper = tables["method_publications"].join(of("publication", "publication_id"), "publication_id", "left_semi").select("method_id")
    ids = {"dataset_id": of("dataset", "dataset_id"), "event_id": of("event", "event_id"), "method_id": of("method", "method_id").union(by_paper)}
    view = archive_views(tables, ["observation_search"])["observation_search"]
    columns, marks = view.columns, fresh(view, *["hit"] * len(ids))
    for mark, (key, found) in zip(marks, ids.items()):
        view = view.join(written(found.distinct()).withColumn(mark, F.lit(True)), key, "left")  # written: Spark knows how few they are
    # Samples found may be as many as rows: only rows that nothing else has found are shuffled to meet them.
    touched = F.coalesce(*marks, F.lit(False))
    return view.filter(touched).select(*columns).union(view.filter(~touched).join(of("sample", "sample_id"), "sample_id", "left_semi").select(*columns))
