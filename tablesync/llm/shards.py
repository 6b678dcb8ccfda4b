"""Operator 3: shards of equal weight by vector bin packing of groups of equal texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.mixing import word_count
from tablesync.llm.shared import saved

PER_CLASS = 256  # bundles of small groups per size class, at least
LARGE = 256  # a group over this part of a shard is packed by itself
WEIGHT = np.array([8.0, 1.0, 1.0])  # of bytes, tokens and rows
PIECES = 8  # pieces per shard's worth of a group too large for one shard
SLOT_ROWS = 50_000


def pack(vectors: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each row of ``vectors`` (bytes, tokens, rows).

    Every shard's capacity is an equal part of the totals. Rows are placed from the largest to the smallest, each where
    the dot product of its vector with the shard's residual capacity, both in parts of the capacity, is highest. Bytes
    are the law, so they weigh most in the product.
    """
    capacity = np.maximum(vectors.sum(axis=0) / shards, 1e-9)
    parts = vectors / capacity
    residual, chosen = np.ones((shards, vectors.shape[1])), np.zeros(len(vectors), np.int64)
    for i in np.lexsort((np.arange(len(parts)), -parts.max(axis=1))):
        chosen[i] = best = int(np.argmax(residual @ (parts[i] * WEIGHT)))
        residual[best] -= parts[i]
    return chosen


def _copies(rows: DataFrame, large: DataFrame) -> DataFrame:
    """(row, copy) for rows of large groups that repeat id and text: a number from 1 for each but the first.

    Rows are numbered inside each partition of the input and shifted by the counts of the partitions before. Which of equal rows gets a number
    does not matter.
    """
    name = F.concat_ws(" ", F.col("doc_id").isNull().cast("string"), F.col("doc_id").cast("string"), "group").alias("name")
    held = rows.join(F.broadcast(large.select("group")), "group", "left_semi").select(name, "row", F.shiftright("row", 33).alias("part"))
    counts = held.groupBy("name", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))).where("n > 1 or shift > 0").drop("n")
    numbered = held.join(shifts, ["name", "part"]).withColumn("n", F.row_number().over(Window.partitionBy("name", "part").orderBy("row")))
    return saved(numbered.select("row", (F.col("shift") + F.col("n") - 1).alias("copy")).where("copy > 0"), "copies")


def assign_shards(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, own: list[str] | None = None
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, tokens, law, shard, slot, grown_shard, and the columns in ``keep``. With
    ``own``, only those of its own columns, so that ``keep`` may hold the names of the others.

    ``size`` is the text's UTF-8 bytes plus 8, ``tokens`` its words between blanks; a null text has no bytes and the CRC of
    none, and is a group of its own kind beside the empty text. ``law`` is bytes: shards hold nearly equal bytes, and as
    equal tokens and rows as that allows. ``slot`` numbers the rows of a shard from 0 without gaps, in the order of a
    hash of id and text, so reruns agree. ``grown_shard`` is null.

    Equal texts are one group and stay together, unless a group outweighs a whole shard in bytes, tokens or rows: it
    is cut into pieces of about 1/``PIECES`` of a shard by the hash of the ids. Rows of a large group that repeat an id, or have none, are numbered,
    and the number counts with the id, so neither a piece nor a range of slots fills up with them. Groups over 1/``LARGE`` of a shard, of which there can be
    no more than 3 * ``shards`` * ``LARGE``, are packed one by one; all others by bundles: each size class has
    as many as it holds parts of 1/``LARGE`` of a shard, or ``PER_CLASS`` if that is more.
    The driver packs these few thousand vectors; texts are read once, and neither written nor shuffled unless they are kept. A single text larger than a
    shard's part makes that shard larger. No documents, no rows.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        word_count(text).alias("tokens"),
        F.coalesce(F.sha2(text, 256), F.lit("null")).alias("group"),
        *[F.col(c).alias(f"kept_{c}") for c in keep or []],
        F.monotonically_increasing_id().alias("row"),
    )
    rows = saved(rows, "sizes")
    groups = rows.groupBy("group", "size", "tokens").agg(F.count("*").alias("n"))
    weigh = [F.col("size") * F.col("n"), F.col("tokens") * F.col("n"), F.col("n")]
    total = groups.agg(*[F.sum(w).cast("double").alias(c) for w, c in zip(weigh, "btr", strict=True)]).first()
    capacity = [max((total[c] or 0) / shards, 1e-9) for c in "btr"]
    part = F.greatest(*[w / F.lit(c) for w, c in zip(weigh, capacity, strict=True)])
    pieces = F.when(part > 1, F.ceil(part * PIECES)).otherwise(1).cast("int")
    # bounded: groups over 1/LARGE of a shard in one of three weights
    large = saved(groups.withColumn("part", part).where(F.col("part") > 1 / LARGE).select("group", pieces.alias("pieces")), "large")

    rows = rows.join(_copies(rows, large), "row", "left").withColumn("copy", F.coalesce("copy", F.lit(0))).drop("row")
    slim = rows.select("doc_id", "size", "tokens", "group", "copy")
    dealt_by = F.when(F.col("copy") > 0, F.xxhash64("doc_id", "copy")).otherwise(F.xxhash64("doc_id"))

    size_class = F.floor(F.log2("size"))
    classes = groups.withColumn("part", part).where(F.col("part") <= 1 / LARGE).groupBy(size_class.alias("class"))
    bundles = F.lit(PER_CLASS)
    for r in classes.agg(*[F.sum(w).cast("double").alias(c) for w, c in zip(weigh, "btr", strict=True)]).collect():
        most = max(r[c] / held for c, held in zip("btr", capacity, strict=True))
        bundles = F.when(size_class == r["class"], max(PER_CLASS, int(np.ceil(most * LARGE)))).otherwise(bundles)

    def bundled(frame: DataFrame) -> DataFrame:
        """Add the bundle: a large group's piece, else a size class and a hash of the group."""
        joined = frame.join(F.broadcast(large), "group", "left")
        own = F.concat_ws("/", "group", F.pmod(dealt_by, F.col("pieces")))
        share = F.concat_ws("-", size_class, F.pmod(F.xxhash64("group"), bundles))
        return joined.withColumn("bundle", F.xxhash64(F.when(F.col("pieces").isNull(), share).otherwise(own))).drop("pieces")

    weights = bundled(slim).groupBy("bundle").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r"))
    weights = weights.orderBy("bundle").toArrow()
    place = pack(np.stack([weights.column(c).to_numpy().astype(float) for c in "btr"], axis=1), shards)
    spark = docs.sparkSession
    placed = spark.createDataFrame(list(zip(weights.column("bundle").to_pylist(), place.tolist(), strict=True)), "bundle long, shard int")

    dealt = bundled(rows).join(F.broadcast(placed), "bundle").drop("bundle")
    buckets = int(max(64, (total.r or 0) // (shards * SLOT_ROWS)))
    order = F.when(F.col("copy") > 0, F.xxhash64("doc_id", "group", "copy")).otherwise(F.xxhash64("doc_id", "group"))
    dealt = dealt.withColumn("at", order).withColumn("bucket", F.pmod("at", F.lit(buckets)))
    counts = bundled(slim).join(F.broadcast(placed), "bundle").select("shard", F.pmod(order, F.lit(buckets)).alias("bucket"))
    counts = counts.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = saved(counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "offsets")
    inside = Window.partitionBy("shard", "bucket").orderBy("at", "doc_id", "group")
    numbered = dealt.withColumn("n", F.row_number().over(inside)).join(offsets, ["shard", "bucket"])
    made = {
        "doc_id": F.col("doc_id"), "size": F.col("size"), "text_crc32": F.col("text_crc32"), "tokens": F.col("tokens"), "law": F.lit("bytes"),
        "shard": F.col("shard"), "slot": (F.col("offset") + F.col("n") - 1).cast("long"), "grown_shard": F.lit(None).cast("int"),
    }
    return numbered.select(*[c.alias(n) for n, c in made.items() if own is None or n in own], *[F.col(f"kept_{c}").alias(c) for c in keep or []])
