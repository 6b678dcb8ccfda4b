"""Operator 4: a quality classifier, a linear support vector machine on n-grams scaled by class log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.shared import saved, texts_of, whole_rows
from tablesync.llm.words import BLOCK, mix, text_bytes

_U = np.uint64
DIMENSIONS = 1 << 17
MAX_TRAIN_ROWS = 6000

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
# What a character is, for the shapes of words: 0 other, 1 lower case, 2 upper case, 3 digit, 4 beyond ASCII.
_KIND = np.zeros(256, np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 4


def _slot(x: np.ndarray, salt: int) -> np.ndarray:
    return (mix(x.astype(_U) + _U(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> _U(47)).astype(np.int64)


def _shapes(text: np.ndarray) -> np.ndarray:
    """One number per word (text between blanks): the kinds of its first and last characters, which kinds occur, its
    length class, and whether it repeats the word before."""
    word = ~_BLANK[text]
    edge = np.diff(np.concatenate([[0], word.astype(np.int8), [0]]))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(a):
        return np.zeros(0, np.int64)
    kind = _KIND[text]
    held = np.zeros(len(a), np.int64)
    for k in range(1, 5):
        held |= (np.add.reduceat((kind == k) & word, a) > 0).astype(np.int64) << (k - 1)
    size = b - a
    # sums of squared characters tell neighbours apart well enough to see a repeated word
    total = np.add.reduceat(np.where(word, text, 0).astype(np.int64) ** 2, a)
    first, last = text[a].astype(np.int64), text[b - 1].astype(np.int64)
    again = np.zeros(len(a), np.int64)
    again[1:] = (size[1:] == size[:-1]) & (total[1:] == total[:-1]) & (first[1:] == first[:-1]) & (last[1:] == last[:-1])
    tail = np.where(_KIND[last] == 0, last, 256 + _KIND[last])
    length = np.digitize(size, (2, 4, 7, 11))
    return ((((tail * 8 + _KIND[first]) * 16 + held) * 8 + length) * 2) + again


def features(text: np.ndarray) -> np.ndarray:
    """The slots of a text's n-grams: bytes by one, two and three, shapes of words by one, two and three."""
    seen = np.zeros(DIMENSIONS, bool)
    carry = np.zeros(0, np.int64)
    k = 0
    while k < len(text):  # long texts in blocks that end between words and overlap by what an n-gram needs
        e = min(k + BLOCK, len(text))
        if e < len(text) and len(blanks := np.flatnonzero(_BLANK[text[k:e]])):
            e = k + int(blanks[-1]) + 1
        b = text[max(k - 2, 0) : e].astype(np.int64)
        seen[_slot(b, 1)] = True
        seen[_slot(b[:-1] << 8 | b[1:], 2)] = True
        seen[_slot(b[:-2] << 16 | b[1:-1] << 8 | b[2:], 3)] = True
        s = np.concatenate([carry, _shapes(text[k:e])])
        seen[_slot(s, 4)] = True
        seen[_slot(s[:-1] << 20 ^ s[1:], 5)] = True
        seen[_slot(s[:-2] << 40 ^ s[1:-1] << 20 ^ s[2:], 6)] = True
        carry, k = s[-2:], e
    return np.flatnonzero(seen)


@dataclass
class Model:
    """weight already holds the ratio of each slot; a text's vector is scaled to length one."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, slots: np.ndarray) -> float:
        length = float(np.sqrt(self.square[slots].sum()))
        return self.bias + (float(self.weight[slots].sum()) / length if length else 0.0)

    def score(self, slots: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(slots) + self.shift, -30, 30))))


def log_ratios(rows: list[np.ndarray], good: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Per slot, the log of its share among good rows over its share among the others."""
    counts = [np.full(DIMENSIONS, smooth) for _ in range(2)]
    for slots, y in zip(rows, good, strict=True):
        counts[int(y)][slots] += 1
    bad, fine = counts
    return np.log(fine / fine.sum()) - np.log(bad / bad.sum())


def _descend(rows: list[np.ndarray], good: np.ndarray, cost: float, rounds: int) -> Model:
    """Dual coordinate descent for the hinge loss: one multiplier per row, each moved to its best value in turn."""
    ratio = log_ratios(rows, good)
    square = ratio**2
    scale = [1 / max(float(np.sqrt(square[s].sum())), 1e-12) for s in rows]
    weight, bias, dual = np.zeros(DIMENSIONS), 0.0, np.zeros(len(rows))
    sign = np.where(good, 1.0, -1.0)
    rng = np.random.default_rng(4)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            slots, y = rows[i], sign[i]
            x = ratio[slots] * scale[i]
            slope = y * (float(weight[slots] @ x) + bias) - 1
            new = min(max(dual[i] - slope / (1.0 + min(len(slots), 1)), 0.0), cost)
            step = (new - dual[i]) * y
            if step:
                weight[slots] += step * x
                bias += step
                dual[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4 * cost:
            break
    return Model(weight * ratio, square, bias)


def _sigmoid(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn margins into probabilities, by Newton steps on the smoothed likelihood."""
    n1, n0 = int(good.sum()), int((~good).sum())
    want = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    at, x = np.array([1.0, 0.0]), np.stack([margins, np.ones(len(margins))], axis=1)
    loss = lambda v: np.logaddexp(0, x @ v).sum() - want @ (x @ v) + 1e-6 * (v @ v)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        gradient = x.T @ (p - want) + 2e-6 * at
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 2e-6 * np.eye(2), gradient)
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def train(rows: list[np.ndarray], good: np.ndarray, cost: float = 1.0, rounds: int = 40, folds: int = 3) -> Model:
    """Fit on slots and labels; probabilities are set by margins of rows that a fold's model has not seen. Without rows,
    or with one label only, every score is the smoothed share of good rows."""
    n1, n = int(good.sum()), len(good)
    if n1 in (0, n):
        p = (n1 + 1) / (n + 2)
        return Model(np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), 0.0, 0.0, float(np.log(p / (1 - p))))
    margins, fold = np.zeros(n), np.arange(n) % folds
    for f in range(folds):
        inside = np.flatnonzero(fold != f)
        part = _descend([rows[i] for i in inside], good[inside], cost, rounds)
        for i in np.flatnonzero(fold == f):
            margins[i] = part.margin(rows[i])
    model = _descend(rows, good, cost, rounds)
    model.slope, model.shift = _sigmoid(margins, good)
    return model


def held_out(id_col: Column) -> Column:
    """Rows kept for testing: CRC-32 of the id as text is a multiple of 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _slots_of(text) -> Iterator[np.ndarray]:
    data, off = text_bytes(text)
    for a, b in zip(off[:-1], off[1:], strict=True):
        yield features(data[a:b])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS
) -> Model:
    """Train on at most ``max_rows`` labelled documents that are not ``held_out``, chosen by the hash of their ids.

    Labels other than 0 and 1, and ids with both, are not used; rows that repeat a label count once. The bound holds for
    the documents too, if ids repeat there. Features are made by tasks; the driver gets the slots of the sample.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    sample = known.select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = pa.array([s.astype(np.int32) for s in _slots_of(batch.column(2))], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), slots], names=["at", "label", "slots"])

    # at most max_rows ids: their size is bounded, whatever the tables hold
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    made = texts.select(F.xxhash64("doc_id").alias("at"), "label", "text").mapInArrow(read, "at long, label int, slots array<int>")
    made = saved(made, "slots")
    # the rows are ordered here, as flat arrays: a sort by Spark would hold all of them as row objects in the driver's heap
    rows = (made if made.count() <= max_rows else made.orderBy("at", "slots").limit(max_rows)).toArrow()
    slots = [np.asarray(v.values) for v in rows.column("slots")]
    at, label = rows.column("at").to_numpy(), rows.column("label").to_numpy().astype(bool)
    order = np.argsort(at, kind="stable")
    if len(np.unique(at)) < len(at):
        order = np.array(sorted(range(len(at)), key=lambda i: (at[i], slots[i].tolist())), np.int64)
    return train([slots[i] for i in order], label[order])


def _judged(slim: DataFrame, model: Model, text_col: str) -> DataFrame:
    """(row, score) of rows with a struct ``row``, which holds the text unless there is a column ``text``."""
    shared = slim.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(s) for s in _slots_of(texts_of(batch, text_col))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    return slim.mapInArrow(judge, f"row {slim.schema['row'].dataType.simpleString()}, score double")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    ``score`` is the probability of label 1, from the whole text and nothing else; a null counts as empty, and an empty
    text, which has no n-grams, gets the model's score without evidence. Repeated documents are scored row by row.
    """
    judged = _judged(docs.select(F.struct(F.col(id_col).alias("doc_id")).alias("row"), F.col(text_col).alias("text")), model, text_col)
    return judged.select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The documents, with all their columns, that ``score`` predicts to be good."""
    judged = _judged(docs.select(F.struct(*whole_rows(docs)).alias("row")), model, text_col)
    return judged.where(F.col("score") >= threshold).select("row.*")
