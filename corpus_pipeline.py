"""The corpus pipeline: quality classifier, similarity join, decontamination, mixing, sharding, in this order.

Each stage gets the documents that its predecessor kept and returns documents with the same columns; the last one adds the
shard and the slot of each row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesync.llm.decontaminate import keep_clean
from tablesync.llm.mixing import mixed
from tablesync.llm.near import one_per_class
from tablesync.llm.quality import fit, keep_good
from tablesync.llm.shards import assign_shards
from tablesync.llm.shared import saved


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels of these documents, does not reject."""
    return keep_good(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_per_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their source ask for."""
    return mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their shard and slot; a document's own column of such a name is replaced."""
    added = ["size", "text_crc32", "law", "shard", "slot"]
    own = [c for c in docs.columns if c not in (*added, "doc_id")]
    return assign_shards(docs, keep=own, own=["doc_id", *added]).select("doc_id", *own, *added)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", similar),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

#: A trained model, MinHash and greedy packing have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, "stage")
    return docs
