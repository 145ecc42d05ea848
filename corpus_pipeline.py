"""A corpus pipeline of five stages: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor. All but the last return the columns
of documents; labels for the two fitted stages come from ``labels`` in ``sf_dir``.

Defined cases, in every stage: a null text counts as empty and keeps being null in the rows that stay; an empty or very
long text is a document like others; rows with a null id are documents like others but never labelled; rows that share an
id are told apart by their texts; further columns of documents stay until the last stage, whatever they are called;
empty documents give an empty result and empty labels leave both fitted stages without effect on any class of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obskit.llm import exact_index, mixing, pieces, simhash, toxicity
from obskit.llm.common import durable, held_out, table

#: Documents with this toxicity score or more go.
TOXIC = 0.5
#: Token shares of the two domains that are left when toxic documents are gone.
QUALITY = {"clean": 0.94, "junk": 0.06}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score stays below ``TOXIC``; copies of a text score alike, so they go or stay together."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return toxicity.score(docs, model).filter(F.col("score") < TOXIC).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after lower-casing A-Z, the row with the largest id; of rows that repeat it, one. Null and
    empty texts are equal."""
    return exact_index.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of fingerprints that link, that of the smallest id; texts without words are one
    component."""
    return simhash.keep_one(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says: none, once or several times. Toxic ones are gone: two domains are left."""
    good = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("domain"))
    mixed = mixing.mix(docs, good, QUALITY)
    repeated = F.explode(F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies"))))
    return mixed.select("row", repeated.alias("copy")).select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids; the copies of a document are numbered, so that dropout cuts each in its own way."""
    copy = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id"))
    tokens = pieces.encode(docs.select("doc_id", "text", copy.alias("copy")), key=("doc_id", "copy"))
    return tokens.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_domains),
    ("sentencepiece", tokenize),
]

#: Fitted models and fuzzy keys have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = durable(docs)
    return docs
