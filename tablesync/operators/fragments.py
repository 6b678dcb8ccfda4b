"""Many literal fragments looked for in all text cells at once.

A fragment of up to 16 characters is looked up whole: a cell holds it if one of the cell's runs of that length equals it. A longer one can be held only by a cell that holds
each of its runs of 16 characters; the run that the fewest cells hold is looked up, and only rows that hold it are searched for the fragment. The runs of the cells are
hashed in numpy where the texts are read, and pass a sieve of bits, sent to every task, before any is made, shuffled or written; equality is then told by the runs
themselves. The plan has one size for any number of fragments.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tablesync.functions.text import string_columns
from tablesync.operators.placement import cut

RUN = 16  # characters of the longest run; a shorter fragment is its own run
WORDS = 1 << 20  # of 64 bits, of the sieve, a power of two; many more runs than words let more pass, which are told apart afterwards
BLOCK, CHUNK, MADE = 1 << 20, 1 << 14, 1 << 20  # bytes of text, places hashed and runs made at a time, so that a task's memory stays bounded

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15


def _grams(text: Column, n: int) -> Column:
    """All runs of ``n`` characters of a text, each once; one pass over the text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))


def _points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of some texts one after the other, and where each text begins, and the end."""
    coded = [t.as_buffer().to_pybytes().decode("utf-8", "replace").encode("utf-32-le") for t in texts]
    return np.frombuffer(b"".join(coded), "<u4"), np.cumsum([0, *(len(c) // 4 for c in coded)])


def _hashes(points: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` characters, put together from runs of half the length."""
    out, have = points.astype(_U), 1
    for odd in f"{n:b}"[1:]:
        out, have = out[:-have] * _U(pow(_BASE, have, 1 << 64)) + out[have:], 2 * have
        if odd == "1":
            out, have = out[:-1] * _U(_BASE) + points[have:], have + 1
    out ^= out >> _U(32)
    out *= _U(0xBF58476D1CE4E5B9)
    return out ^ (out >> _U(29))


def _word(hashes: np.ndarray, words: int) -> np.ndarray:
    """The word of the sieve that each run belongs to."""
    return ((hashes >> _U(18)) & _U(words - 1)).view(np.int64)


def _bit(hashes: np.ndarray, k: int) -> np.ndarray:
    """One of the three bits that each run has in its word."""
    return (hashes >> _U(6 * k)) & _U(63)


def _sieve(grams: DataFrame) -> Broadcast:
    """The bits of all runs, set by tasks and combined word by word; the driver gets at most ``WORDS`` words."""
    words = WORDS

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, starts = _points(batch.column(0))
            lengths = np.diff(starts)
            for n in np.unique(lengths).tolist():
                hashes = _hashes(points, n)[starts[:-1][lengths == n]]
                bits = reduce(np.bitwise_or, (_U(1) << _bit(hashes, k) for k in range(3)))
                yield pa.RecordBatch.from_arrays([pa.array(_word(hashes, words)), pa.array(bits.view(np.int64))], names=["word", "bits"])

    found = grams.select("gram").mapInArrow(put, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(words, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return grams.sparkSession.sparkContext.broadcast(out.view(_U))


def _passing(points: np.ndarray, starts: np.ndarray, n: int, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of runs of ``n`` characters inside one text that pass the sieve, and the numbers of their texts."""
    places = [np.zeros(0, np.int64)]
    for lo in range(0, len(points) - n + 1, CHUNK):
        hashes = _hashes(points[lo : lo + CHUNK + n - 1], n)
        held = sieve.take(_word(hashes, len(sieve)), mode="clip")
        near = np.flatnonzero((held >> _bit(hashes, 0)) & _U(1))
        for k in (1, 2):
            near = near[((held[near] >> _bit(hashes[near], k)) & _U(1)).astype(bool)]
        places.append(near + lo)
    place = np.concatenate(places)
    text = np.searchsorted(starts, place, "right") - 1
    inside = place + n <= starts[text + 1]
    return place[inside], text[inside]


def _made(points: np.ndarray, place: np.ndarray, n: int) -> pa.Array:
    """The runs of ``n`` characters at some places."""
    signs = points[place[:, None] + np.arange(n)]
    sizes = (1 + (signs > 0x7F) + (signs > 0x7FF) + (signs > 0xFFFF)).sum(axis=1)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(place), pa.py_buffer(ends), pa.py_buffer(signs.tobytes().decode("utf-32-le").encode()))


def _runs_held(texts: pa.Array, sizes: list[int], sieve: np.ndarray) -> pa.Table:
    """(text, gram): the runs of some texts that pass the sieve, each once a text; ``text`` is the number of the text."""
    points, starts = _points(texts)
    found = [pa.table({"text": pa.array([], pa.int64()), "gram": pa.array([], pa.string())})]
    for n in sizes:
        place, text = _passing(points, starts, n, sieve)
        made = [
            pa.table({"text": text[lo : lo + MADE], "gram": _made(points, place[lo : lo + MADE], n)}).group_by(["text", "gram"], use_threads=False).aggregate([])
            for lo in range(0, len(place), MADE)
        ]
        found += made if len(made) < 2 else [pa.concat_tables(made).group_by(["text", "gram"], use_threads=False).aggregate([])]
    return pa.concat_tables(found).select(["text", "gram"])


def _finder(shared: Broadcast, sizes: list[int], keys: list[str], together: bool):
    """For mapInArrow: (keys, col, text, _apart) to (keys, col, gram, _n): ``_n`` texts hold the run. ``together``, texts that are not apart are counted without their keys."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = [0, *(np.flatnonzero(np.diff(ends // BLOCK)) + 1).tolist(), len(ends)]
            for lo, hi in zip(cuts, cuts[1:]):
                part = batch.slice(lo, hi - lo)
                found = _runs_held(part.column("text"), sizes, shared.value)
                found = found.append_column("col", part.column("col").take(found.column("text").combine_chunks()))
                if together:
                    found = found.set_column(0, "text", pc.if_else(part.column("_apart").take(found.column("text").combine_chunks()), found.column("text"), None))
                found = found.group_by(["text", "col", "gram"], use_threads=False).aggregate([([], "count_all")])
                own = part.select([*range(len(keys))]).take(found.column("text").combine_chunks())
                yield from pa.table([*own.columns, *(found.column(c) for c in ("col", "gram", "count_all"))], names=[*keys, "col", "gram", "_n"]).to_batches()

    return find


def _parts(fragments: DataFrame, any_case: bool) -> tuple[DataFrame, list[int], set[bool]]:
    """(fragment, body, gram) for each run that a cell with the fragment must hold; the lengths of runs; whether these are whole fragments (True), parts of longer ones (False) or both."""
    body = F.lower("fragment") if any_case else F.col("fragment")
    wanted = cut(fragments.select("fragment", body.alias("body")).where("fragment <> ''").distinct())
    runs = F.when(F.length("body") <= RUN, F.array("body")).otherwise(_grams(F.col("body"), RUN))
    parts = cut(wanted.select("fragment", "body", F.explode(runs).alias("gram")))
    kinds = parts.select(F.length("gram").alias("n"), (F.col("gram") == F.col("body")).alias("whole")).distinct().collect()  # at most RUN + 1
    return parts, sorted({r.n for r in kinds}), {r.whole for r in kinds}


def _text_names(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in string_columns(df) if c.lower() not in {k.lower() for k in keys}]


def _texts(df: DataFrame, keys: list[str], names: list[str], any_case: bool) -> DataFrame:
    """(keys, col, text) for every cell with a text, of rows with keys."""
    folded = (lambda c: F.lower(c)) if any_case else (lambda c: c)
    cells = F.array(*[F.struct(F.lit(c).alias("col"), folded(F.col(f"`{c}`")).alias("text")) for c in names])
    rows = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True)))
    return rows.select(*keys, *(["_apart"] if "_apart" in df.columns else []), F.inline(cells)).where("text <> ''")


def _held(texts: DataFrame, keys: list[str], parts: DataFrame, sizes: list[int], together: bool = False) -> DataFrame:
    """(keys, col, gram, _n): ``_n`` texts of that column hold a run that passes the sieve."""
    fields = [StructField(k, texts.select(k).schema[0].dataType) for k in keys]
    out = StructType([*fields, StructField("col", StringType()), StructField("gram", StringType()), StructField("_n", LongType())])
    return texts.mapInArrow(_finder(_sieve(parts), sizes, keys, together), out)


def _hits(df: DataFrame, keys: list[str], names: list[str], found: tuple[DataFrame, list[int], set[bool]], any_case: bool) -> DataFrame:
    parts, sizes, kinds = found
    if not sizes or not names:
        return df.select(*keys, F.lit(None).cast("string").alias("col"), F.lit(None).cast("string").alias("fragment")).limit(0)
    texts = _texts(df, keys, names, any_case)
    pairs = cut(_held(texts, keys, parts, sizes).join(parts.select("gram").distinct(), "gram"))
    whole = pairs.groupBy(*keys, "col", "gram").agg(F.sum("_n").alias("_n")).join(parts.where("gram = body"), "gram")
    for _ in range(2):  # rows of equal keys are not told apart: what one holds counts for each
        whole = whole.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    whole = whole.select(*keys, "col", "fragment")
    if False not in kinds:
        return whole
    counts = pairs.groupBy("gram").agg(F.count("*").alias("n"))
    rank = Window.partitionBy("fragment").orderBy("n", "gram")
    # a run that no cell holds rules its fragment out
    rarest = parts.where("gram <> body").join(counts, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = cut(rarest.withColumn("r", F.row_number().over(rank)).where("r = 1 and n > 0").select("fragment", "body", "gram"))
    candidates = pairs.join(rarest, "gram").groupBy(*keys, "col").agg(F.collect_list(F.struct("fragment", "body")).alias("_f"))
    joined = texts.withColumnRenamed("col", "_c").join(candidates.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("col").alias("_col"), "_f"),
        [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)] + [F.col("_c") == F.col("_col")])
    held = F.filter("_f", lambda f: F.contains(F.col("text"), f["body"]))
    longer = joined.select(*keys, F.col("_c").alias("col"), F.explode(F.transform(held, lambda f: f["fragment"])).alias("fragment"))
    return whole.unionByName(longer) if True in kinds else longer


def fragment_hits(df: DataFrame, keys: list[str], fragments: DataFrame, cols: list[str] | None = None, any_case: bool = False) -> DataFrame:
    """(keys, col, fragment) for every text cell that contains a fragment of ``fragments(fragment)``. Runs at once.

    ``keys`` identify a row. Empty and NULL fragments are found nowhere. With
    ``any_case`` letters are compared without case. Runs are extracted once and written where some fragment has them as its own; a run that very many cells hold is used only by
    long fragments that have no rarer one.
    """
    return _hits(df, keys, cols if cols is not None else _text_names(df, keys), _parts(fragments, any_case), any_case)


def clear_fragments(df: DataFrame, keys: list[str], fragments: DataFrame, not_null: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """Blank every text cell that mentions one of any number of fragments: '' in NOT NULL columns, else NULL. ``keys`` and ``keep`` stay."""
    strict, kept = {c.lower() for c in not_null}, {k.lower() for k in (*keep, *keys)}
    names = [c for c in string_columns(df) if c.lower() not in kept]
    hits = fragment_hits(df, keys, fragments, names).groupBy(*keys).agg(F.collect_set("col").alias("_stale"))
    rows = df.join(hits, keys, "left")
    stale = lambda c: F.coalesce(F.array_contains("_stale", c), F.lit(False))
    blank = {c: F.lit("") if c.lower() in strict else F.lit(None).cast("string") for c in names}
    return rows.select(*[F.when(stale(c), blank[c]).otherwise(F.col(f"`{c}`")).alias(c) if c in blank else F.col(f"`{c}`") for c in df.columns])


def _counts(df: DataFrame, keys: list[str], found: tuple[DataFrame, list[int], set[bool]]) -> DataFrame:
    """(col, fragment, n). Hits may be very many more than fragments: tasks count those of whole fragments where they find them, and only rows that share their keys are told apart."""
    parts, sizes, kinds = found
    names = _text_names(df, keys)
    if True not in kinds or not names or not keys:
        return _hits(df, keys, names, found, False).groupBy("col", "fragment").agg(F.count("*").alias("n"))
    whole = parts.where("gram = body")
    again = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*keys, F.lit(True).alias("_apart"))
    texts = _texts(df.join(cut(again), keys, "left"), keys, names, False)
    each = _held(texts, keys, whole, sizes, True).groupBy(*keys, "col", "gram").agg(F.sum("_n").alias("_n"))
    n = F.when(F.col(keys[0]).isNull(), F.col("_n")).otherwise(F.col("_n") * F.col("_n"))  # as fragment_hits has them
    counts = each.groupBy("col", "gram").agg(F.sum(n).alias("n")).join(whole, "gram").select("col", "fragment", "n")
    if False not in kinds:
        return counts
    longer = _hits(df, keys, names, (parts.where("gram <> body"), [RUN], {False}), False)
    return counts.unionByName(longer.groupBy("col", "fragment").agg(F.count("*").alias("n")))


def fragment_census(tables: dict[str, tuple[DataFrame, list[str]]], fragments: DataFrame) -> DataFrame:
    """Cells that contain a fragment, counted per table, column and fragment; ``tables``: name → (rows, keys)."""
    union, found = None, _parts(fragments, False)
    for table, (df, keys) in tables.items():
        part = _counts(df, keys, found).select(F.lit(table).alias("table_name"), "col", "fragment", "n")
        union = part if union is None else union.unionByName(part)
    return union
