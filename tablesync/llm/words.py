"""Words of whole UTF-8 texts as 64-bit hashes, computed with numpy over the bytes of Arrow columns.

A word is a run of digits, ASCII letters and characters beyond ASCII; A-Z are lower-cased first. A column is worked
through in blocks of about ``BLOCK`` bytes, so memory stays bounded for batches of any size; only a text longer than
that is held with 32 bytes a word.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18
_U = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser: every input bit changes about half of the output bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@functools.lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse, modulo 2**64."""
    def row(base):
        out = np.full(n, base, dtype=_U)
        out[0] = 1
        return np.multiply.accumulate(out)

    return row(_BASE), row(pow(_BASE, -1, 1 << 64))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each text begins; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off.astype(np.int64)


@dataclass
class Words:
    """The words of the texts ``lo`` to ``hi - 1`` of a column."""

    lo: int
    hi: int
    hashes: np.ndarray
    starts: np.ndarray  # byte positions in the column's data
    ends: np.ndarray
    offsets: np.ndarray  # of each text's first word, and the end
    data: np.ndarray

    def joined(self, first: int, last: int) -> bytes:
        """The lower-cased words ``first`` to ``last - 1``, with a blank between."""
        return b" ".join(LOWER[self.data[a:b]].tobytes() for a, b in zip(self.starts[first:last], self.ends[first:last], strict=True))

    def normalised(self, doc: int) -> bytes:
        """All words of a text, with a blank between, without a loop over words."""
        a, b = self.offsets[doc], self.offsets[doc + 1]
        if a == b:
            return b""
        first, last = self.starts[a], self.ends[b - 1]
        low = LOWER[self.data[first:last]]
        word = WORD[low]
        keep = word.copy()
        keep[1:] |= word[:-1]
        return np.where(word, low, 32).astype(np.uint8)[keep].tobytes()


def _words(data: np.ndarray, cuts: np.ndarray, signs: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words in data[cuts[0]:cuts[-1]]; no word goes across a cut. ``signs``: the bytes of words."""
    a, n = cuts[0], cuts[-1] - cuts[0]
    if not n:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = LOWER[data[a : a + n]]
    word = signs[low]
    inner = (cuts[1:-1] - a)
    inner = inner[(inner > 0) & (inner < n)]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    opens[inner] = word[inner]
    closes[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    size = BLOCK if n <= BLOCK else 1 << int(n - 1).bit_length()
    power, inverse = _powers(size)
    sums = np.zeros(n + 1, _U)
    np.cumsum(low.astype(_U) * power[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts]), starts + a, ends + a


def _pieces(data: np.ndarray, a: int, b: int, signs: np.ndarray = WORD) -> Iterator[tuple[int, int]]:
    """Parts of a long text that end between words."""
    while a < b:
        e = min(a + BLOCK, b)
        while e < b:
            gaps = np.flatnonzero(~signs[LOWER[data[a:e]]])
            if len(gaps):
                e = a + int(gaps[-1]) + 1
                break
            e = min(a + 2 * (e - a), b)
        yield a, e
        a = e


def word_blocks(column, signs: np.ndarray = WORD) -> Iterator[Words]:
    """The words of all texts of a column, block by block; a block holds whole texts. ``signs``: the bytes of words."""
    data, off = text_bytes(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(int(np.searchsorted(off, off[lo] + BLOCK, "right")) - 1, lo + 1)
        if off[hi] - off[lo] <= BLOCK:
            h, s, e = _words(data, off[lo : hi + 1], signs)
        else:
            parts = [_words(data, np.array(p), signs) for p in _pieces(data, int(off[lo]), int(off[hi]), signs)]
            h, s, e = (np.concatenate(x) for x in zip(*parts, strict=True))
        yield Words(lo, hi, h, s, e, np.searchsorted(s, off[lo : hi + 1]), data)
        lo = hi


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` neighbouring words."""
    if len(hashes) < n:
        return np.zeros(0, _U)
    last = len(hashes) - n + 1
    out = np.full(last, n, dtype=_U)
    for k in range(n):
        out = out * _U(0xD6E8FEB86659FD93) + hashes[k : k + last]
    return mix(out)
