"""A training corpus from documents: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterweave.llm.common import remainder, stored, table
from meterweave.llm.decontamination import clean_documents
from meterweave.llm.mixing import mixed_documents
from meterweave.llm.near import first_of_groups
from meterweave.llm.sharding import shard_rows
from meterweave.llm.toxicity import without_toxic

SHARDS = 24


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on two thirds of the labels, does not reject."""
    return without_toxic(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, a similarity of 0.8."""
    return first_of_groups(docs, similarity=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words of a benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to weights 1, 2, 3: a document once for each pass over its source that takes words of it."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in a uniform random order in shards of equal row counts."""
    named = docs.withColumn("__text", F.xxhash64("text"))
    return shard_rows(named, SHARDS, ["doc_id", "__text"]).drop("__text")


STAGES = [
    ("toxicity", toxicity), ("near duplicates", near_duplicates), ("decontamination", decontamination),
    ("mixing", mixing), ("sharding", sharding),
]

#: SQL has neither the classifier nor the pseudorandom draws; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir: the columns of documents, shard and slot."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
