"""Operator 8: benchmark passages in documents, by a prefix-filtered join of word windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.shared import texts_of, whole_rows
from tablesync.llm.words import Words, run_hashes, word_blocks

_U = np.uint64
BLOCK_BYTES = 16 << 20


@dataclass
class Windows:
    """The distinct windows of some items, by their rarest word."""

    rare: np.ndarray  # hash of the rarest word, sorted: the one-token prefix an exact match needs
    place: np.ndarray  # of that word in its window
    length: np.ndarray
    run: np.ndarray  # hash of all words of the window
    text: list[bytes]
    items: list[list]  # the items that have the window

    def hits(self, words: Words, k: int) -> tuple[np.ndarray, list]:
        """(which words of text k lie inside an occurrence of a window, the items of these windows)."""
        a, b = int(words.offsets[k]), int(words.offsets[k + 1])
        own = words.hashes[a:b]
        marks = np.zeros(len(own) + 1, np.int64)
        first, last = np.searchsorted(self.rare, own, "left"), np.searchsorted(self.rare, own, "right")
        found: set = set()
        sums: dict[int, np.ndarray] = {}
        at = np.flatnonzero(last > first)
        many = (last - first)[at]
        for lo in range(0, len(at), 4096):  # candidates in parts, so that memory is bounded
            n = many[lo : lo + 4096]
            pos = np.repeat(at[lo : lo + 4096], n)
            window = np.repeat(first[at[lo : lo + 4096]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = pos - self.place[window]
            # positional and length bounds: the window must lie inside the text
            inside = (start >= 0) & (start + self.length[window] <= len(own))
            start, window = start[inside], window[inside]
            for size in np.unique(self.length[window]):
                if size not in sums:
                    sums[size] = run_hashes(own, int(size))
                of = self.length[window] == size
                same = of.copy()
                same[of] = sums[size][start[of]] == self.run[window[of]]
                for s, w in zip(start[same].tolist(), window[same].tolist(), strict=True):
                    if words.joined(a + s, a + s + int(size)) == self.text[w]:
                        marks[s] += 1
                        marks[s + int(size)] -= 1
                        found.update(self.items[w])
        return np.cumsum(marks)[:-1] > 0, list(found)


def _item_words(items: list[tuple]) -> Iterator[tuple[object, Words, int]]:
    texts = pa.array([t for _, t in items], pa.large_string())
    for words in word_blocks(texts):
        for k in range(words.hi - words.lo):
            yield items[words.lo + k][0], words, k


def build_windows(items: list[tuple], counts: dict[int, int], size: int) -> Windows:
    """Windows of (item_id, text) rows; ``counts`` has how often each word (by hash) occurs in the documents."""
    by_text: dict[bytes, tuple] = {}
    for item, words, k in _item_words(items):
        a, b = int(words.offsets[k]), int(words.offsets[k + 1])
        if a == b:
            continue
        n = min(size, b - a)
        runs = run_hashes(words.hashes[a:b], n)
        for s in range(len(runs)):
            text = words.joined(a + s, a + s + n)
            if text in by_text:
                by_text[text][4].append(item)
                continue
            hashes = words.hashes[a + s : a + s + n].tolist()
            place = min(range(n), key=lambda p: (counts.get(hashes[p], 0), hashes[p]))
            by_text[text] = (hashes[place], place, n, int(runs[s]), [item])
    rows = sorted(by_text.items(), key=lambda x: x[1][0])
    return Windows(
        np.array([r[1][0] for r in rows], _U), np.array([r[1][1] for r in rows], np.int64), np.array([r[1][2] for r in rows], np.int64),
        np.array([r[1][3] for r in rows], _U), [r[0] for r in rows], [r[1][4] for r in rows],
    )


def _counter(vocabulary):
    """For mapInArrow: how often each benchmark word occurs in the texts of a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value if len(vocabulary.value) else np.zeros(1, _U)
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for words in word_blocks(batch.column(0)):
                at = np.searchsorted(known, words.hashes)
                at[at == len(known)] = 0
                total += np.bincount(at[known[at] == words.hashes], minlength=len(known))
        some = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(known[some].view(np.int64)), pa.array(total[some])], names=["word", "n"])

    return count


def _marker(shared, first: bool, last: bool, text_col: str):
    """For mapInArrow: add the hits of one block of items to each document's row; the last block drops the text."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for batch in batches:
            before, texts = None if first else (batch.column("hit"), batch.column("items")), texts_of(batch, text_col)
            for words in word_blocks(texts):
                n_words, n_hit, hits, items = [], [], [], []
                for k in range(words.hi - words.lo):
                    hit, found = windows.hits(words, k)
                    if before is not None:
                        hit |= np.unpackbits(np.frombuffer(before[0][words.lo + k].as_py(), np.uint8), count=len(hit)).astype(bool)
                        found = [*found, *before[1][words.lo + k].as_py()]
                    n_words.append(len(hit))
                    n_hit.append(int(hit.sum()))
                    hits.append(np.packbits(hit).tobytes())
                    items.append(sorted(set(found)))
                part = batch.slice(words.lo, words.hi - words.lo)
                judged = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string()))]
                if last:
                    yield pa.RecordBatch.from_arrays([part.column("row"), *judged], names=["row", "n_words", "n_hit", "items"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [part.column("row"), texts.slice(words.lo, words.hi - words.lo), judged[2], pa.array(hits, pa.binary())], names=["row", "text", "items", "hit"]
                    )

    return mark


def _marked(
    slim: DataFrame, texts: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, size: int, block_bytes: int
) -> DataFrame:
    """(row, n_words, n_hit, items) of rows with a struct ``row``, which holds the text unless there is a column ``text``;
    ``texts`` has them as its one column."""
    sc = slim.sparkSession.sparkContext
    row_type = slim.schema["row"].dataType.simpleString()
    out, first, blocks = slim, True, _item_blocks(benchmark, item_col, item_text_col, block_bytes)
    items: list[tuple] | None = next(blocks, [])
    while items is not None:
        hashes = [w.hashes[w.offsets[k] : w.offsets[k + 1]] for _, w, k in _item_words(items)]
        vocabulary = sc.broadcast(np.unique(np.concatenate([np.zeros(0, _U), *hashes])))
        counted = texts.mapInArrow(_counter(vocabulary), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
        found = counted.toArrow() if items else None  # at most one row per word of the block
        counts = dict(zip(found.column("word").to_numpy().view(_U).tolist(), found.column("n").to_pylist(), strict=True)) if items else {}
        shared = sc.broadcast(build_windows(items, counts, size))
        items = next(blocks, None)
        kept = "text string, items array<string>, hit binary" if items is not None else "n_words long, n_hit long, items array<string>"
        out = out.mapInArrow(_marker(shared, first, items is None, text_col), f"row {row_type}, {kept}")
        first = False
    return out


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 10,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (ids as strings, sorted), items_sha256, contaminated.

    Words are lower-cased (A-Z) runs of digits, letters and characters beyond ASCII. A window is ``size`` consecutive
    words of an item; an item of fewer words, but not none, is one window. A document word inside any occurrence of a
    window is hit.

    An exact match of a window must contain its rarest word, so that one word, by its frequency in all documents, is the
    window's prefix. Document words that are such a prefix give candidates; the place of the word in the window and the
    lengths of both bound where the window can lie; what is left is compared word by word. A text is scanned in place:
    nothing but frequencies is shuffled. Windows go to every task, so the benchmark is worked through in blocks of at most
    ``block_bytes`` of text (a single larger item is a block of its own), one pass each, whose hits add up.

    Null and empty documents have no words and no hits; items without words match nothing; items with the same id count
    once, null ids as one id. Repeated documents are judged row by row. Without items nothing is contaminated.
    """
    slim = docs.select(F.struct(F.col(id_col).alias("doc_id")).alias("row"), F.col(text_col).alias("text"))
    out = _marked(slim, slim.select("text"), benchmark, text_col, item_col, item_text_col, size, block_bytes)
    return out.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 10, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents, with all their columns, that ``contamination`` finds no hit in."""
    slim = docs.select(F.struct(*whole_rows(docs)).alias("row"))
    out = _marked(slim, docs.select(F.col(text_col)), benchmark, text_col, item_col, item_text_col, size, block_bytes)
    return out.where("n_hit = 0").select("row.*")


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks, streamed: the driver holds one block at a time."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")), F.col(text_col))
    block, held = [], 0
    for item, text in rows.where(F.col(text_col).isNotNull()).toLocalIterator():
        if block and held + len(text) > block_bytes:
            yield block
            block, held = [], 0
        block.append((item, text))
        held += len(text)
    if block:
        yield block
