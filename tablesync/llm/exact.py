"""Operator 5: exact duplicates by salted digest groups that compare full content. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.shared import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed; a null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest.

    Texts are equal when identical after ``normalised``. Of equal texts the row with the largest doc_id stays; a null id
    is smaller than any other, and a group of null ids only keeps keep_id null (its rows count as kept). Rows that
    repeat the largest id are all kept. Empty texts are equal to each other and to nulls.

    Three stages, each of which groups by digest *and* text, so that texts with one digest stay apart: a task folds its
    own copies (map-side aggregation), copies from tasks of one salt are folded, then the salts' winners of a digest.
    A group of a third of all rows therefore reaches its last task as at most ``salts`` rows. The winners, without their
    texts, then meet the documents by digest; for digests that two texts share, and only for those, the texts are joined
    as well. ``digest`` is any expression over the normalised text.
    """
    text = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("body"), digest(text).alias("digest"))

    salted = rows.withColumn("salt", F.spark_partition_id() % salts)
    local = salted.groupBy("digest", "body", "salt").agg(F.max("doc_id").alias("top"), F.count("*").alias("n"))
    whole = local.repartition("digest").groupBy("digest", "body").agg(F.max("top").alias("top"), F.sum("n").alias("n"))
    winners = saved(
        whole.groupBy("digest").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"), F.count("*").alias("texts")), "winners"
    )

    ids = rows.select("doc_id", "digest")
    alone = ids.join(winners.where("texts = 1").drop("texts"), "digest")

    out = ["doc_id", "keep_id", "group_size", "digest"]
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    shown = ["doc_id", "keep_id", "group_size", kept, "digest"]
    if winners.where("texts > 1").isEmpty():
        return alone.select(*shown)
    clashing = rows.join(winners.where("texts > 1").select("digest"), "digest", "left_semi")
    parted = clashing.groupBy("digest", "body").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    apart = clashing.join(parted, ["digest", "body"])
    return alone.select(*out).unionByName(apart.select(*out)).select(*shown)
