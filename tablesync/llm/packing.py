"""Operator 13: token sequences of equal length and equal cost, from whole documents that may be cut.

The cost of a piece is linear in its tokens (the dense layers) plus quadratic (attention inside the piece). Pieces are
taken from the longest to the shortest, each to the sequence of the lowest cost that has room for it.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_VOCABULARY_BYTES = 64 << 20
GROUP = 512  # full sequences that are packed together
CACHED = 700_000  # words whose ids a worker keeps, twice at most
CACHED_CHARS = 40  # of a word, at most
LATIN = "ɏ"  # lower-case letters up to here are their own normal form
_ODD = re.compile("[^\x00-\u012f\u0131-\u024f]|<\\|")  # what does not fold letter by letter, or may begin a special token
_STOP = re.compile("[a-zß-öø-ÿ][.,](?= )")
_OTHER_STOP = re.compile("[^a-zß-öø-ÿ][.,] ")


def piece_sizes(total: int, capacity: int) -> list[int]:
    """Sizes of the sequences that hold ``total`` tokens without padding: full ones, and the rest in powers of two."""
    full, rest = divmod(total, capacity)
    return [capacity] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


@dataclass(frozen=True)
class Cost:
    """What ``n`` tokens that attend to each other cost: ``linear * n + quadratic * n * n``."""

    linear: float = 1.0
    quadratic: float = 1 / 6144  # attention over n tokens costs as much as the dense layers of width 1024 at n = 6144

    def of(self, n):
        return self.linear * n + self.quadratic * n * n


def pack_group(lengths: list[int], capacity: int, cost: Cost, last: bool = True) -> tuple[list[tuple], list[tuple]]:
    """Pieces (sequence, offset, document, start, length) of documents of these lengths, by sequence and offset, and what is
    left over for the next group as (document, start, length): less than ``capacity``, and nothing of the ``last`` group.

    What exceeds ``capacity`` is cut off in full sequences first. The others go, from the longest to the shortest (of equal
    ones the earlier document first), to the sequence of the lowest cost (of equal ones the first) with room for all of the piece. Where
    none has, the sequence of the lowest cost with any room is filled up and the rest of the piece waits for its turn. The sequences
    have just the room that ``piece_sizes`` states (before the last group only the full ones), so all are full at the end.
    """
    made, waiting, full = [], [], 0
    for doc, n in enumerate(lengths):
        whole = n // capacity
        for k in range(whole):
            made.append((full, 0, doc, k * capacity, capacity))
            full += 1
        if n % capacity:
            waiting.append((-(n % capacity), doc, whole * capacity))
    heapq.heapify(waiting)
    sizes = [n for n in piece_sizes(-sum(w[0] for w in waiting), capacity) if last or n == capacity]
    room, spent, used = np.array(sizes, np.int64), np.zeros(len(sizes)), np.zeros(len(sizes), np.int64)
    while waiting and room.any():
        length, doc, start = heapq.heappop(waiting)
        length = -length
        fits = room >= length
        if not fits.any():
            fits = room > 0
        best = int(np.where(fits, spent, np.inf).argmin())
        n = min(length, int(room[best]))
        made.append((full + best, int(used[best]), doc, start, n))
        room[best] -= n
        used[best] += n
        spent[best] += cost.of(n)
        if n < length:
            heapq.heappush(waiting, (n - length, doc, start + n))
    return sorted(made), sorted((doc, start, -n) for n, doc, start in waiting)


class _Words(dict):
    """Ids of words between blanks as bytes, kept for the words met last."""

    def __init__(self, encode, model):
        super().__init__()
        self._encode, self._model, self._older = encode, model, {}
        # how the byte-level step writes bytes as characters: printable ones as they are, the others from 256 on
        same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in same]
        self._signs = {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(other)}

    def __missing__(self, word: str) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = self._ids(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self._older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if len(word) <= CACHED_CHARS and word.isalpha() and word.islower():
            if word.isascii():
                return _packed([t.id for t in self._model.tokenize(word)])
            if max(word) <= LATIN:
                return _packed([t.id for t in self._model.tokenize("".join(self._signs[b] for b in word.encode()))])
        return _packed(self._encode(word))

    def text(self, text: str) -> bytes:
        """The ids of a text. Where letters fold one by one, they are folded at once, and a stop or comma between a letter and a blank,
        which is a piece of its own, is cut off: so fewer different words are met."""
        text = text.replace("\n", " ")
        if text.isascii() and "<|" not in text or not _ODD.search(text):
            text = text.lower()
            if _OTHER_STOP.search(text):
                text = _STOP.sub(lambda m: f"{m[0][0]} {m[0][1]}", text)
            else:
                text = text.replace(". ", " . ").replace(", ", " , ")
        return b"".join(map(self.__getitem__, text.split(" ")))


def _packed(ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@functools.lru_cache(2)
def _encoder(config: bytes):
    """A function from a text to its ids as bytes.

    A vocabulary that drops white space, folds case and marks the ends of words encodes each run between blanks by itself, so
    words met before are looked up; any other one gets whole texts.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(config.decode())
    parts = json.loads(config)
    steps = [s["type"] for s in (parts.get("normalizer") or {}).get("normalizers", [])]
    cuts = [s["type"] for s in (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    ends = parts["model"].get("end_of_word_suffix")

    def encode(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    if steps == ["NFC", "Replace", "Lowercase"] and cuts == ["Split", "ByteLevel"] and ends and parts["model"]["type"] == "BPE":
        words = _Words(encode, tokenizer.model)
        return words.text
    return lambda text: _packed(encode(text))


def pack_sequences(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, group: int = GROUP, cost: Cost | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset, sequence_tokens, sequence_cost.

    A document is the ids of its whole text and ``end_id``; a null or empty text is ``end_id`` alone. ``start`` counts the ids of the
    document before the piece, ``doc_tokens`` all of them; ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers, as token files
    do. Each id lies in exactly one piece, and each sequence has no gap. Sequences hold ``capacity`` tokens or a smaller power of
    two (the rest of a task, at most one of each size), so none needs padding. Repeated rows and ids are documents like any other; no documents, no rows.

    One pass without a shuffle: a task gathers its documents until ``group`` sequences are full, packs these and goes on, so memory holds one
    group and one document. Which documents meet depends on how Spark deals the rows; a task that runs again gives
    the same pieces. The vocabulary file is read by the driver, at most ``MAX_VOCABULARY_BYTES``, and sent to the tasks.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    with open(tokenizer_path, "rb") as f:
        config = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(config) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{tokenizer_path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    shared = docs.sparkSession.sparkContext.broadcast(config)
    price, end = cost or Cost(), _packed([end_id])
    slim = docs.select(F.struct(F.col(id_col).alias("doc_id")).alias("row"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared.value)
        first = TaskContext.get().partitionId() << 40  # sequences of a task are numbered from here
        rows, held, tokens = [], [], 0  # held: ids not packed yet, how many of the document's are before them, and in all

        def packed(last=False):
            nonlocal first, rows, held, tokens
            made, left = pack_group([len(ids) // 4 for ids, _, _ in held], capacity, price, last)
            count, spent = {}, {}
            for s, _, _, _, n in made:
                count[s] = count.get(s, 0) + n
                spent[s] = spent.get(s, 0.0) + price.of(n)
            whole = pa.concat_arrays(rows)
            columns = {
                "row": whole.take(pa.array([d for _, _, d, _, _ in made], pa.int64())),
                "start": pa.array([held[d][1] + p for _, _, d, p, _ in made], pa.int64()),
                "length": pa.array([n for *_, n in made], pa.int64()),
                "ids": pa.array([held[d][0][4 * p : 4 * (p + n)] for _, _, d, p, n in made], pa.binary()),
                "doc_tokens": pa.array([held[d][2] for _, _, d, _, _ in made], pa.int64()),
                "sequence_id": pa.array([first + s for s, *_ in made], pa.int64()),
                "offset": pa.array([o for _, o, *_ in made], pa.int64()),
                "sequence_tokens": pa.array([count[s] for s, *_ in made], pa.int64()),
                "sequence_cost": pa.array([spent[s] for s, *_ in made], pa.float64()),
            }
            first += len(count)
            rows = [whole.take(pa.array([d for d, _, _ in left], pa.int64()))]
            held = [(held[d][0][4 * p : 4 * (p + n)], held[d][1] + p, held[d][2]) for d, p, n in left]
            tokens = sum(n for *_, n in left)
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            begin = 0
            for at, text in enumerate(batch.column(1)):
                ids = (encode(text.as_py()) if text.is_valid else b"") + end
                held.append((ids, 0, len(ids) // 4))
                tokens += len(ids) // 4
                if tokens >= group * capacity:
                    rows.append(batch.column(0).slice(begin, at + 1 - begin))
                    begin = at + 1
                    yield packed()
            if begin < len(batch):
                rows.append(batch.column(0).slice(begin))
        if held:
            yield packed(last=True)

    kind = slim.schema["row"].dataType.simpleString()
    out = slim.mapInArrow(
        run,
        f"row {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_tokens long, sequence_cost double",
    )
    return out.select("row.*", *[c for c in out.columns if c != "row"])


def sequences(pieces: DataFrame, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """One row per sequence: sequence_id, ids (padded with ``pad_id`` to ``capacity`` unless it is a power of two), tokens, cost, and spans, the pieces
    in order as (doc_id, start, length), between which attention is masked. A sequence holds at most ``capacity`` pieces."""
    inner = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    rows = pieces.groupBy("sequence_id").agg(inner.alias("p"), F.sum("length").alias("tokens"), F.first("sequence_cost").alias("cost"))
    ids = F.aggregate("p", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    pad = F.unhex(F.repeat(F.lit(_packed([pad_id]).hex()), F.when(F.expr("bit_count(tokens) = 1"), 0).otherwise(F.lit(capacity) - F.col("tokens")).cast("int")))
    spans = F.transform("p", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["start"].alias("start"), p["length"].alias("length")))
    return rows.select("sequence_id", F.concat(ids, pad).alias("ids"), "tokens", "cost", spans.alias("spans"))
