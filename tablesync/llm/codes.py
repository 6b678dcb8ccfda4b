"""Operator 11: vectors as short codes of codebook entries, exact in integers.

Components become integers. Squared distances are |x|^2 - 2 x.c + |c|^2, and the dot products are matrix products of *limbs*: the
bits of the integers are cut so that every sum inside a float64 product stays below 2^53 and is therefore exact in any order. The
limb products are put together in int64; the first smallest distance decides.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.shared import saved

SUM_BITS = 40  # of a limb in which sums travel, so that a long holds the sum of millions of them
BLOCK = 4096  # rows in one matrix product
LONG = (1 << 63) - 1


def limb_bits(dim: int) -> int:
    """The widest limbs whose products over ``dim`` places stay within 2^53."""
    return (53 - max(dim - 1, 0).bit_length()) // 2


def split_limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Integers as float64 limbs of ``bits`` bits, the lowest first; the last one carries the sign."""
    top = max((abs(int(values.max(initial=0))), abs(int(values.min(initial=0)))))
    n = max(1, -(-top.bit_length() // bits))
    mask = (1 << bits) - 1
    return [((values >> (bits * k)) & mask if k < n - 1 else values >> (bits * k)).astype(np.float64) for k in range(n)]


def exact_product(left: np.ndarray, right: np.ndarray, inner: int | None = None) -> np.ndarray:
    """The matrix product of integer matrices by float64 products of their limbs.

    int64 matrices are put together modulo 2^64, which is exact where the product itself fits; matrices of Python integers
    (dtype object) are exact at any size. ``inner``: how many summands can differ from zero, if fewer than all.
    """
    bits = limb_bits(inner or left.shape[1])
    wide = left.dtype == object or right.dtype == object
    total = np.zeros((left.shape[0], right.shape[1]), object if wide else np.uint64)
    tops = split_limbs(right, bits)
    for i, a in enumerate(split_limbs(left, bits)):
        for j, b in enumerate(tops):
            part, shift = (a @ b).astype(np.int64), bits * (i + j)
            if wide:
                total += part.astype(object) << shift
            elif shift < 64:
                total += part.view(np.uint64) << np.uint64(shift)
    return total if wide else total.view(np.int64)


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value), exact: int64, or Python integers where they may not fit. ``scale`` is a power of two."""
    values = values.astype(np.float64)
    if np.abs(values).max(initial=0.0) < 2.0**62 / scale:
        return np.floor(values * scale).astype(np.int64)
    exact = [int(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale) for v in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


@dataclass(frozen=True)
class Codebooks:
    """``entries[part][entry]`` is a tuple of integers. ``dim`` is the length of the vectors; the last part is filled with zeros
    where ``dim`` does not divide."""

    entries: tuple
    dim: int
    scale: int

    @property
    def width(self) -> int:
        return -(-self.dim // len(self.entries))

    @property
    def digest(self) -> str:
        flat = (str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()

    def cut(self, vectors: np.ndarray) -> np.ndarray:
        """Integer parts of float vectors: rows, parts, places."""
        whole = integers(vectors, self.scale)
        filled = np.zeros((len(whole), self.width * len(self.entries)), whole.dtype)
        filled[:, : self.dim] = whole
        return filled.reshape(len(whole), len(self.entries), self.width)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each part the index of the nearest entry, the lower one of a tie, and the squared distance."""
        books = np.array(self.entries, object).reshape(len(self.entries), len(self.entries[0]), self.width)
        reach = sum(max((abs(int(a.max(initial=0))), abs(int(a.min(initial=0))))) for a in (parts, books))
        kind = np.int64 if reach * reach * max(parts.shape[1] * self.width, 1) <= LONG else object
        parts, books = parts.astype(kind), books.astype(kind)
        codes = np.zeros(parts.shape[:2], np.int64)
        errors = np.zeros(parts.shape[:2], kind)
        for p in range(parts.shape[1]):
            x, c = parts[:, p], books[p]
            away = (x * x).sum(axis=1)[:, None] - 2 * exact_product(x, c.T) + (c * c).sum(axis=1)[None, :]
            codes[:, p] = away.argmin(axis=1)
            errors[:, p] = away[np.arange(len(x)), codes[:, p]]
        return codes, errors


def _floats(column, dim: int) -> Iterator[np.ndarray]:
    """Blocks of the rows of a list column, whose lists all have ``dim`` values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)
    for at in range(0, len(flat), BLOCK):
        yield flat[at : at + BLOCK]


def _carry(total: int) -> Iterator[int]:
    """A whole number as limbs of ``SUM_BITS`` bits, the lowest first; the last one has the sign."""
    while abs(total) >= 1 << SUM_BITS:
        yield total & ((1 << SUM_BITS) - 1)
        total >>= SUM_BITS
    yield total


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry moved to the floor of the mean of its parts. Each task sums its own rows; Spark adds the sums up."""
    shared = rows.sparkSession.sparkContext.broadcast(books)  # parts * entries * width numbers

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        n_parts, n_entries = len(books.entries), len(books.entries[0])
        counts = np.zeros((n_parts, n_entries), np.int64)
        total = np.zeros((n_parts, n_entries, books.width), object)
        for batch in batches:
            for block in _floats(batch.column(0), books.dim):
                parts = books.cut(block)
                codes, _ = books.nearest(parts)
                for p in range(n_parts):
                    member = (codes[:, p][None, :] == np.arange(n_entries)[:, None]).astype(np.int64)
                    counts[p] += member.sum(axis=1)
                    total[p] += exact_product(member, parts[:, p]).astype(object)
        made = [
            (p, e, j, k, limb, int(counts[p, e]))
            for p, e in zip(*np.nonzero(counts), strict=True)
            for j in range(books.width)
            for k, limb in enumerate(_carry(int(total[p, e, j])))
        ]
        columns = [[int(v) for v in c] for c in zip(*made, strict=True)] or [[]] * 6
        types = [pa.int32()] * 4 + [pa.int64()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["p", "e", "j", "k", "limb", "n"])

    made = rows.select("vector").mapInArrow(sums, "p int, e int, j int, k int, limb long, n long")
    added = made.groupBy("p", "e", "j", "k").agg(F.sum(F.col("limb").cast("decimal(20,0)")).alias("limb"), F.sum("n").alias("n"))
    totals, counts = {}, {}
    for r in added.collect():  # one row per number of the codebooks and limb
        totals[r.p, r.e, r.j] = totals.get((r.p, r.e, r.j), 0) + (int(r.limb) << (SUM_BITS * r.k))
        if r.k == 0:
            counts[r.p, r.e] = int(r.n)
    entries = tuple(
        tuple(
            tuple(totals[p, e, j] // counts[p, e] for j in range(books.width)) if (p, e) in counts else entry
            for e, entry in enumerate(part)
        )
        for p, part in enumerate(books.entries)
    )
    shared.unpersist()
    return Codebooks(entries, books.dim, books.scale)


def _usable(vector: str) -> F.Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def fit_codebooks(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding") -> Codebooks | None:
    """Codebooks of all usable vectors: each part position starts from the ``entries`` smallest ids and moves ``rounds`` times.

    Usable is a vector that is not null, holds no null, NaN or infinity, and has the most common length (of equally common ones the
    greater). Rows that repeat an id are ordered by their vector; a null id comes last. With fewer usable vectors than
    ``entries`` there are as many entries as vectors; with none the result is None. Every round reads all vectors once; only
    sums by entry leave the tasks, however the rows are spread or repeated.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    if scale < 1 or scale & (scale - 1):
        raise ValueError("scale must be a power of two")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).where(_usable("vector"))
    common = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return None
    rows = rows.where(F.size("vector") == common.dim)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    empty = Codebooks(((),) * parts, common.dim, scale)
    start = empty.cut(np.array([r.vector for r in first], np.float64).reshape(len(first), common.dim))
    books = Codebooks(tuple(tuple(tuple(int(v) for v in row) for row in start[:, p]) for p in range(parts)), common.dim, scale)
    for _ in range(rounds if common.dim else 0):
        books = _moved(rows, books)
    return books


def compress(vectors: DataFrame, books: Codebooks | None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector that is not null and holds no null, NaN or infinity: vec_id, label, code, error, label_error.

    ``code`` has the index of the nearest entry of each part as two hex digits, ``error`` the sum of the squared distances, ``label_error``
    the sum of ``error`` over all rows of an equal label, nulls together. A vector of another length than the codebooks' has
    a null code and error; so has an error (or a label's sum) that a long cannot hold, while codes are exact for all
    finite values. Repeated ids and vectors are rows like any other; no vectors, no rows.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")).where(_usable("vector"))
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    dim = books.dim if books else -1
    fits = F.size("vector") == dim

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            codes, errors = [], []
            for block in _floats(batch.column(1), books.dim):
                index, away = books.nearest(books.cut(block))
                codes += [bytes(row).hex() for row in index.astype(np.uint8)]
                errors += [int(e) if e <= LONG else None for e in away.sum(axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=["row", "code", "error"])

    slim = rows.select(F.struct("vec_id", "label").alias("row"), "vector")
    kind = slim.schema["row"].dataType.simpleString()
    others = slim.where(~fits).select("row", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = others if books is None else slim.where(fits).mapInArrow(encode, f"row {kind}, code string, error long").unionByName(others)
    coded = saved(coded.select("row.*", "code", "error"), "codes")
    totals = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    totals = totals.select(F.col("label").alias("of"), F.col("total").try_cast("long").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
