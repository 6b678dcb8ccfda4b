"""Operator 9: mix sources to target weights by Pareto order sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.shared import saved

WORD = r"[^\x20\x09-\x0D]+"
BINS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(id_col: Column) -> Column:
    """A number in (0, 1) that depends on the id alone: 48 bits of its MD5 digest."""
    digits = F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit(""))), 1, 12), 16, 10).cast("long")
    return (digits + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), one row per source.

    Sources by code point, null last, weigh ``cycle``, repeating. All words are shared by weight; a target stops at
    ``most`` times its source's size and what is over goes to the others by weight, until none is above. That end state
    is found at once: with sources in the order of size over weight, those up to some place are full and the others get
    one common level times their weight. The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weights = F.array(*[F.lit(w) for w in cycle])
    rows = sizes.withColumn("weight", F.get(weights, (F.row_number().over(by_name) - 1) % len(cycle)))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    cap = F.lit(most) * F.col("source_size")
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("level", left / open_weight).withColumn("full", F.col("level") * F.col("weight") > cap)
    # the level of the first source that stays below its cap holds for all after it
    level = F.min(F.when(~F.col("full"), F.struct((F.col("source_size") / F.col("weight")).alias("fill"), "level"))).over(everything)
    open_ = F.col("source_size") / F.col("weight") >= level["fill"]
    target = F.when(open_, F.least(level["level"] * F.col("weight"), cap.cast("double"))).otherwise(cap.cast("double"))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def _decided(docs: DataFrame, id_col: str, text_col: str, source_col: str, cycle: tuple[int, ...], most: int, row: list[Column] | None):
    """(doc_id, size, source, source_size, target, copies), and the columns of ``row`` as a struct if they are given."""
    drawn = [F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), uniform(F.col(id_col)).alias("u")]
    slim = saved(docs.select(*drawn, word_count(F.col(text_col)).alias("size")), "sizes")
    plan = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, most)
    held = F.col("source_size") > 0
    plan = plan.withColumn("whole", F.when(held, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    # the odds of inclusion for what the whole copies leave; 0 when they leave nothing
    plan = saved(plan.withColumn("share", F.when(held, F.col("need") / F.col("source_size")).otherwise(0.0)), "plan")

    open_ = plan.where("share > 0").select("source", "need", "share")
    rank = F.try_divide(F.col("u") / (1 - F.col("u")), F.col("share") / (1 - F.col("share")))
    ranked = _meet(slim, open_, "inner").withColumn("place", F.struct(rank.alias("rank"), "u", "doc_id"))
    coarse, fine = F.floor(F.col("u") * BINS), F.floor(F.col("u") * (BINS * BINS))
    one = saved(_reached(ranked.withColumn("spent", F.lit(0).cast("long")), coarse), "bins")
    two = saved(_reached(_meet(ranked, one, "inner").where(coarse == F.col("bin")).drop("bin"), fine), "bins")

    last = _meet(ranked, two, "inner").where(fine == F.col("bin"))
    last = last.groupBy("source", "need", "spent", "place").agg(F.sum("size").alias("size"))
    earlier = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    last = last.withColumn("got", F.col("spent") + F.sum("size").over(earlier)).where("got <= need")
    ends = last.groupBy("source").agg(F.max("place").alias("end"), F.max("got").alias("got"))
    cut = _meet(_meet(open_, two, "inner"), ends, "left")
    cut = saved(cut.select("source", (F.col("need") - F.coalesce("got", "spent")).alias("gap"), "bin", "end"), "cuts")

    sampled = (fine < F.col("bin")) | (fine == F.col("bin")) & F.coalesce(F.col("place") <= F.col("end"), F.lit(False))
    # what is open then is closed by unsampled documents: large ones first, as many as fit, then the one that comes nearest.
    # A histogram of sizes finds the size at which no more fit; documents of that size follow their places, found as above
    left = _meet(ranked.drop("need"), cut, "inner").where(~sampled & (F.col("size") > 0) & (F.col("size") <= F.col("gap")))
    left = left.drop("bin", "end").withColumnRenamed("gap", "need").withColumn("spent", F.lit(0).cast("long"))
    sizes = saved(left.groupBy("source", "need", "spent", (-F.col("size")).alias("step")).agg(F.sum("size").alias("size")), "bins")
    full = saved(_reached(sizes, F.col("step")), "bins")
    edge = _meet(left.drop("spent"), full, "inner").where(-F.col("size") == F.col("bin")).drop("bin")
    one = saved(_reached(edge, coarse), "bins")
    two = saved(_reached(_meet(edge.drop("spent"), one, "inner").where(coarse == F.col("bin")).drop("bin"), fine), "bins")
    last = _meet(edge.drop("spent"), two, "inner").where(fine == F.col("bin"))
    last = last.groupBy("source", "need", "spent", "place").agg(F.sum("size").alias("size"))
    last = last.withColumn("got", F.col("spent") + F.sum("size").over(earlier)).where("got <= need")
    ends = last.groupBy("source").agg(F.max("place").alias("fill_end"), F.max("got").alias("got"))
    fills = _meet(sizes.groupBy("source").agg(F.sum("size").alias("all")), full.select("source", F.col("bin").alias("step")), "left")
    fills = _meet(_meet(fills, two.select("source", F.col("bin").alias("fill_bin"), "spent"), "left"), ends, "left")
    fills = fills.withColumn("filled", F.when(F.col("step").isNull(), F.col("all")).otherwise(F.coalesce("got", "spent")))
    cut = _meet(cut, fills.select("source", (-F.col("step")).alias("fill_size"), "fill_bin", "fill_end", "filled"), "left")
    cut = saved(cut.withColumn("open", F.col("gap") - F.coalesce("filled", F.lit(0))), "cuts")

    first = (fine < F.col("fill_bin")) | (fine == F.col("fill_bin")) & F.coalesce(F.col("place") <= F.col("fill_end"), F.lit(False))
    fits = F.col("fill_size").isNull() | (F.col("size") > F.col("fill_size")) | (F.col("size") == F.col("fill_size")) & first
    filler = (F.col("size") > 0) & (F.col("size") <= F.col("gap")) & fits
    off = F.abs(F.col("open") - F.col("size"))
    rest = _meet(ranked, cut, "inner").where(~sampled & ~filler & (F.col("size") < 2 * F.col("open")))
    rest = rest.groupBy("source", "open", "place").agg(F.sum("size").alias("size")).where(off < F.col("open"))
    extra = rest.groupBy("source").agg(F.min(F.struct(off.alias("off"), "place")).alias("extra"))
    cut = saved(_meet(cut, extra.select("source", F.col("extra.place").alias("added")), "left"), "cuts")

    decided = docs.select(*drawn, word_count(F.col(text_col)).alias("size"), F.struct(*row).alias("row")) if row else slim
    rows = _meet(_meet(decided, plan, "left"), cut, "left").withColumn("place", F.struct(rank.alias("rank"), "u", "doc_id"))
    picked = (F.col("share") > 0) & (sampled | filler | F.coalesce(F.col("place") == F.col("added"), F.lit(False)))
    return rows.withColumn("copies", F.col("whole") + F.coalesce(picked, F.lit(False)).cast("long"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cycle: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, copies, taken.

    A source's expected copies are its target over its size. The whole part is certain: every document is taken so many
    times. The rest of the target is a Pareto order sample: each source has its own odds of inclusion, its documents are
    ranked by their random odds over those, and taken in that order while they fit, so the sample's size is fixed in
    words. The words then open, fewer than the next document has, are closed by unsampled documents: those that are small
    enough, from the largest on, as many as fit, and the one whose size comes nearest to the rest, if that brings the
    source closer to its target. Random numbers come from the id's digest, so reruns agree.

    No source is gathered: a histogram of the random numbers, whose ``BINS`` bins hold about equally many documents,
    finds the bin in which the target is reached, a second one splits that bin again, and only the rows of the last bin,
    one in ``BINS`` squared, are ordered by a window. The closing documents are found in the same way, after a histogram of
    their sizes.

    A null or empty text has size 0. Null sources are a source of their own, the last one. Rows with the same id and
    source are taken or left together. No documents, no rows; if all texts are empty, all targets are 0.
    """
    rows = _decided(docs, id_col, text_col, source_col, cycle, most, None)
    return rows.select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cycle: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
) -> DataFrame:
    """The documents, with all their columns, as often as ``mix`` takes them. The decision follows from a document's id
    and source and a few rows per source, so the texts are not shuffled."""
    rows = _decided(docs, id_col, text_col, source_col, cycle, most, [F.col(f"`{c}`") for c in docs.columns])
    repeated = rows.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return repeated.select("row.*")


def _meet(rows: DataFrame, per_source: DataFrame, how: str) -> DataFrame:
    """Add the columns of one row per source to rows; null is a source too. Spark chooses the join by the sizes it sees."""
    other = per_source.withColumnRenamed("source", "_source")
    return rows.join(other, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _reached(rows: DataFrame, bins: Column) -> DataFrame:
    """(source, bin, spent): the bin in which the running total of sizes passes the need, and the total before it."""
    sums = rows.groupBy("source", "need", "spent", bins.alias("bin")).agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.col("spent") + F.coalesce(F.sum("words").over(order), F.lit(0)))
    passed = sums.where(F.col("before") + F.col("words") > F.col("need"))
    return passed.groupBy("source").agg(F.min("bin").alias("bin"), F.min("before").alias("spent"))
